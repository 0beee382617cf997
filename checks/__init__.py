"""The jobs run on the test tables, each beside plain SQL for the same rows."""

from checks import q_evaluation, q_functions, q_jobs, q_operators, q_tables  # noqa: F401
from checks.registry import ORACLES, QUERIES  # noqa: F401
