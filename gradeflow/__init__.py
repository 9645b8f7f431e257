"""gradeflow: validation and analytics of academic records as Spark jobs."""

from gradeflow.contract import CONTRACTS, POLICY, RULES, contract
from gradeflow.plans.alerts import ALERTS
from gradeflow.plans.batch import BatchResult, GateInputs, current_run, read_silver, rebuild, run_batch
from gradeflow.plans.gold import Analytics, GoldInputs, GoldTable
from gradeflow.plans.performance import PERFORMANCE
from gradeflow.plans.validation import Validation, validate
from gradeflow.sources.bronze import profile, read_bronze

__all__ = [
    "ALERTS",
    "Analytics",
    "BatchResult",
    "GateInputs",
    "CONTRACTS",
    "GoldInputs",
    "GoldTable",
    "PERFORMANCE",
    "POLICY",
    "RULES",
    "Validation",
    "contract",
    "current_run",
    "profile",
    "read_bronze",
    "read_silver",
    "rebuild",
    "run_batch",
    "validate",
]
