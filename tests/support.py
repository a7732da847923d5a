"""What the test modules share; ``conftest`` modules hold fixtures only."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"


def same_rows(a, b) -> bool:
    """Equal as bags of rows, columns by name."""
    names = sorted(a.columns)
    if sorted(b.columns) != names:
        return False
    quoted = ["`" + n.replace("`", "``") + "`" for n in names]
    a, b = a.select(quoted), b.select(quoted)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def exchanges(df) -> int:
    """Shuffles of the physical plan, broadcasts not counted."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange shufflepartition")


def plan_of(df) -> str:
    """The physical plan with nothing cut short."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
