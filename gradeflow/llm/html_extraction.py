"""Main text of pages by removing site templates.

All element subtrees are hashed on each page and counted per host, whatever their tags and
classes; inside an article those of containers, so that no heading or paragraph of one goes alone.  Those that recur on many pages of their host are its template and are deleted.
A following step deletes what tags and classes mark as lying around the main text, and
what is outside the articles of a page that still has text in one.  Pages of one main content count once, so that copies of an
article do not turn it into a template.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeflow.llm.common import landed
from gradeflow.llm.markup import Page, main_text, parse
from gradeflow.llm.urls import with_parts

#: A template is on pages of at least so many main contents of a host, whatever the host's size.
MANY = 8
#: A subtree on more than one in so many of all rows of subtrees is hot: there are fewer than that.
HOT = 1000


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, main content and the different subtrees of each page; whether one holds blocks that do not lie around."""
    for batch in batches:
        keys, contents, hashes, felt = [], [], [], []
        for key, host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            page = parse(text.as_py() or "", host)
            inner = [0, *accumulate(not around for around in page.around)]
            own: dict[int, bool] = {}
            for tree in page.subtrees:
                own[tree.hash] = own.get(tree.hash, False) or inner[tree.stop] > inner[tree.start]
            keys.extend([key] * len(own))
            contents.extend([content(page)] * len(own))
            hashes.extend(own)
            felt.extend(own.values())
        columns = [pa.array(values, pa.int64()) for values in (keys, contents, hashes)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(felt, pa.bool_())], ["key", "content", "hash", "felt"])


def content(page: Page) -> int:
    """Tells main contents apart: what is left of a page before any template is known."""
    text = main_text(page, frozenset())
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The html compressed, for the way over the shuffle."""
    for batch in batches:
        packed = [zlib.compress((text.as_py() or "").encode("utf-8"), 6) for text in batch.column(3)]
        columns = [*batch.columns[:3], pa.array(packed, pa.binary()), batch.column(4)]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "host", "packed", "key"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, host, templates in zip(batch.column(3), batch.column(2).to_pylist(), batch.column(4).to_pylist()):
            texts.append(main_text(parse(zlib.decompress(text.as_py()).decode("utf-8"), host), frozenset(templates or ())))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )


def keyed(pages: DataFrame) -> DataFrame:
    """Adds the key by which pages get their templates.

    Should different pages share one, each gets the templates of both, and as hashes tell
    hosts apart, only those in it that are its host's delete anything.
    """
    return pages.withColumn("key", F.xxhash64("host", "html"))


def templates(pages: DataFrame, many: int = MANY, felt: bool = False) -> DataFrame:
    """key, templates: the hashes of a page's subtrees that are on many pages of its host.

    A page's list is bounded by its own subtrees.  Hot subtrees, which a large host's are,
    are looked up in a table of fewer than ``HOT`` rows, so that no task gets all its pages.
    All subtrees are counted; with ``felt``, those are left out of the lists that hold only
    blocks that lie around, which are deleted anyway.
    """
    found = keyed(pages).select("key", "host", "html").mapInArrow(_subtrees, "key long, content long, hash long, felt boolean")
    found = landed(found)
    hot = F.col("rows") > found.count() / HOT
    often = F.col("contents") >= many
    # Contents first: a hot subtree's are dealt out before they are counted.
    counts = found.groupBy("hash", "content").agg(F.count("*").alias("n"))
    counts = counts.groupBy("hash").agg(F.count("*").alias("contents"), F.sum("n").alias("rows"))
    counts = landed(counts.filter(often | hot))
    asked = found.filter("felt") if felt else found
    told = asked.select("key", "hash").join(F.broadcast(counts.filter(hot).select("hash", often.alias("often"))), "hash", "left")
    others = told.filter("often is null").join(counts.filter(often & ~hot).select("hash"), "hash", "left_semi")
    own = told.filter("often").unionByName(others)
    return own.groupBy("key").agg(F.collect_set("hash").alias("templates"))


def extract(pages: DataFrame, many: int = MANY) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``.

    Blocks of the main text are joined by two line ends; white space within a block
    is one space and character references are decoded.  A page whose html is null, empty
    or all template has an empty text; broken markup is read as far as it goes.  A null
    URL has an empty host, like all without "://".  Repeated rows and other copies of a
    main content count as one page and give a row each; an empty table gives none; other
    columns are ignored.
    """
    rows = with_parts(pages.select("page_id", "url", "html"))
    found = landed(templates(rows, many, felt=True))
    columns = "page_id long, url string, host string, packed binary, key long"
    packed = keyed(rows).select(F.col("page_id").cast("long"), "url", "host", "html", "key").mapInArrow(_packed, columns)
    # Lists grow with the pages: neither they nor their hosts' are sent whole to a task.
    joined = packed.join(found.hint("shuffle_hash"), "key", "left")
    joined = joined.select("page_id", "url", "host", "packed", "templates")
    return joined.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
