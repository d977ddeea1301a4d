"""Row and column rules as views that decide by the session's role when they are queried.

The role is a session variable. A protected view names the variable in its text, so whoever reads it writes
the same query in every role. A DataFrame keeps the role that held when it was made from the view.

Only what the service sets counts: statements of users go through ``sql_guard_batch`` first, which lets no SET pass,
and the unprotected table behind a view is not to be named in what users may read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from wayline.functions.text import EMAIL_MASK, PHONE_MASK
from wayline.operators.enrichment import ADMIN_ROLES, ANALYST_ROLE

ROLE = "wayline_role"
#: a session without a role sees no protected row
NO_ROLE = "PUBLIC"
_DECLARED = "spark.wayline.roleDeclared"


def set_role(spark: SparkSession, role: str = NO_ROLE) -> None:
    """The role of all queries of this session from now on."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE} STRING DEFAULT '{NO_ROLE}'")
    spark.sql(f"SET VARIABLE {ROLE} = :role", {"role": role})
    spark.conf.set(_DECLARED, "true")


def _texts(values: Sequence[str]) -> str:
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def role_is(*roles: str) -> str:
    """Condition on the role of the session that runs the query."""
    return f"session.{ROLE} IN ({_texts(roles)})"


def role_rows(rules: Mapping[str, str], admins: Sequence[str] = tuple(ADMIN_ROLES)) -> str:
    """Admins see every row, a role in ``rules`` the rows of its condition, any other role none."""
    allowed = [f"({role_is(role)} AND ({condition}))" for role, condition in rules.items()]
    return " OR ".join([role_is(*admins), *allowed])


#: analysts see completed bookings
BOOKING_ROWS = {ANALYST_ROLE: "booking_status = 'completed'"}


def _masked(column: str, kind: str) -> str:
    c = _name(column)
    if kind == "email":
        return f"concat({_texts([EMAIL_MASK])}, split_part({c}, '@', 2))"
    if kind == "phone":
        return _texts([PHONE_MASK])
    raise ValueError(f"unknown mask {kind}")


def protected_view(df: DataFrame, name: str, rows: Mapping[str, str] | None = None,
                   masks: Mapping[str, str] | None = None, admins: Sequence[str] = tuple(ADMIN_ROLES)) -> DataFrame:
    """Create (or replace) the view ``name`` over a table under rules for rows and columns, and return it as the current
    role sees it.

    ``rows`` gives the condition under which a role sees a row (see ``role_rows``; without it all roles see all rows); a
    condition that is NULL hides the row. ``masks`` names columns ("email" or "phone") that only admins see
    plain. Rules become filters and columns of the query, so filters still reach the scan and a role without
    rows reads nothing.
    """
    spark = df.sparkSession
    if spark.conf.get(_DECLARED, None) is None:
        set_role(spark)
    source = f"{name}_unprotected"
    df.createOrReplaceTempView(_name(source))
    masks = masks or {}
    shown = [f"CASE WHEN {role_is(*admins)} THEN {_name(c)} ELSE {_masked(c, masks[c])} END AS {_name(c)}"
             if c in masks else _name(c) for c in df.columns]
    where = f" WHERE {role_rows(rows, admins)}" if rows is not None else ""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {_name(name)} AS SELECT {', '.join(shown)} FROM {_name(source)}{where}")
    return spark.table(_name(name))
