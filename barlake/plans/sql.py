"""Read-only SQL over given tables.

A query is analyzed in a session of its own, which knows the given tables and nothing else, and
is then accepted by what its *resolved* plan consists of.  Names never decide: however a query
spells a table or a function, what it resolved to is on the list or the query is refused.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

# Relational nodes a query may consist of.  Leaves are literal rows and references to the
# query's own CTEs; given tables stand in their views, which are not entered.
NODES = frozenset(
    "Project Filter Aggregate Join LateralJoin AsOfJoin Sort GlobalLimit LocalLimit Offset Window Distinct Deduplicate "
    "Union Intersect Except Expand Generate Sample Repartition RepartitionByExpression SubqueryAlias WithCTE "
    "CTERelationDef CTERelationRef OneRowRelation LocalRelation UnresolvedHint ResolvedHint".split()
)

# Spark's own groups of built-in functions that compute a value from values.  Its group of
# miscellaneous functions (reflection, session and file information, raised errors) is not here.
FUNCTION_GROUPS = frozenset(
    "agg_funcs array_funcs bitwise_funcs collection_funcs conditional_funcs conversion_funcs csv_funcs datetime_funcs "
    "generator_funcs hash_funcs json_funcs lambda_funcs map_funcs math_funcs predicate_funcs string_funcs "
    "struct_funcs url_funcs variant_funcs window_funcs xml_funcs".split()
)

EXPRESSIONS = "org.apache.spark.sql.catalyst.expressions."
# What analysis puts below a built-in function that it replaces by a call of Spark's own code.
REPLACEMENTS = frozenset(f"{EXPRESSIONS}objects.{name}" for name in ("StaticInvoke", "Invoke"))
USER_CODE = ("UDF", "UDAF", "UDTF", "UserDefinedGenerator")


def _items(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


@functools.cache
def _function_groups() -> dict[str, set[str]]:
    """Expression class -> groups of the built-in functions it stands for."""
    jvm = SparkSession.active()._jvm
    entries = jvm.org.apache.spark.sql.catalyst.analysis.FunctionRegistry.expressions().values().iterator()
    groups: dict[str, set[str]] = {}
    while entries.hasNext():
        info = entries.next()._1()
        # A function that is registered by a builder makes the expression the builder is named after.
        kind = info.getClassName().removesuffix("$").removesuffix("ExpressionBuilder")
        groups.setdefault(kind, set()).add(info.getGroup())
    return groups


def _check_expression(expression, replaced: bool) -> None:
    kind = expression.getClass().getName()
    groups = _function_groups().get(kind)
    if groups is not None:
        allowed = groups <= FUNCTION_GROUPS
        replaced = allowed
    elif kind in REPLACEMENTS:
        allowed = replaced
    else:
        # Not a function by itself: names, literals, casts, frames, and what built-ins are made of.
        allowed = kind.startswith(EXPRESSIONS) and not kind.startswith(f"{EXPRESSIONS}objects.")
        allowed = allowed and not kind.endswith(USER_CODE)
    if not allowed:
        raise ValueError(f"not allowed in a query: {expression.prettyName()}")
    if hasattr(expression, "plan") and _is_subquery(expression):
        _check_plan(expression.plan())
    for child in _items(expression.children()):
        _check_expression(child, replaced)


def _is_subquery(expression) -> bool:
    names = ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery")
    return expression.getClass().getSimpleName() in names


def _check_plan(plan) -> None:
    kind = plan.getClass().getSimpleName()
    if kind == "View":
        name = plan.desc().identifier()
        # The session has no temporary views but the given ones; global ones carry a database.
        if not plan.isTempView() or name.database().isDefined():
            raise ValueError(f"no such table: {name.unquotedString()}")
        return
    if kind.removesuffix("$") not in NODES:
        raise ValueError(f"not allowed in a query: {plan.nodeName()}")
    for expression in _items(plan.expressions()):
        _check_expression(expression, False)
    for child in _items(plan.children()):
        _check_plan(child)


def _isolated(spark: SparkSession, views: Mapping[str, DataFrame]):
    """A session with the caller's settings and the given tables, and no other name."""
    session = spark._jsparkSession.newSession()
    for key, value in spark.conf.getAll.items():
        if not key.startswith("spark.sql.catalog") and spark.conf.isModifiable(key):
            session.conf().set(key, value)
    session.conf().set("spark.sql.runSQLOnFiles", "false")
    for name, df in views.items():
        _dataset(spark, session, df._jdf.queryExecution().analyzed()).createOrReplaceTempView(name)
    return session


def _dataset(spark: SparkSession, session, plan):
    return spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(session, plan)


def sql_over_layers(
    spark: SparkSession,
    query: str,
    views: Mapping[str, DataFrame],
    limit: int | None = None,
    max_length: int | None = None,
) -> DataFrame:
    """Run one SELECT over the given tables, named as in ``views``, and no others.

    The text is placed in a subquery, where Spark's parser accepts nothing but a query: data
    changes, DDL, settings and further statements do not parse.  A query that resolves to
    anything off the list raises ValueError, one that does not resolve Spark's AnalysisException.
    The caller's session, its views included, is not touched, so queries may run at once.
    """
    if max_length is not None and len(query) > max_length:
        raise ValueError(f"query is longer than {max_length} characters")
    text = f"SELECT * FROM (\n{query.strip().removesuffix(';')}\n)"
    plan = _isolated(spark, views).sql(text).queryExecution().analyzed()
    _check_plan(plan)
    result = DataFrame(_dataset(spark, spark._jsparkSession, plan), spark)
    return result if limit is None else result.limit(limit)
