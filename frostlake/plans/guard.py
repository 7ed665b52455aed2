"""Which free SQL may run: a walk over the analysed plan.

The text is analysed, not searched: names, aliases and string literals mean nothing here, only what Spark resolved
them to. A query may read the registered views, literal rows and ranges, and may use any relational operator and any
of Spark's own functions. Refused are relations that are no registered view (paths, catalogue tables), commands,
script transforms, functions that call into the JVM by name, and functions that someone added to the session. A view's
own definition is its owner's, and is not walked.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame

_PLANS = "org.apache.spark.sql.catalyst.plans.logical."
_EXPRESSIONS = "org.apache.spark.sql.catalyst.expressions."
#: Leaves that read nothing from outside.
_FREE_LEAVES = {"OneRowRelation", "OneRowRelation$", "LocalRelation", "Range", "CTERelationRef", "UnionLoopRef", "EmptyRelation"}
_REFUSED_NODES = {"ScriptTransformation"}
_REFUSED_FUNCTIONS = {"CallMethodViaReflection", "TryReflect", "PythonUDF", "PythonUDAF", "PythonUDTF", "ScalaUDF", "PythonFuncExpression"}


class QueryRefused(ValueError):
    """The text is a query, or is none, that may not run here."""


def _items(seq) -> list:
    """The elements of a Scala sequence."""
    return [seq.apply(i) for i in range(seq.size())]


def _class(node) -> str:
    return node.getClass().getName()


def _check_function(expression) -> None:
    stack = [expression]
    while stack:
        e = stack.pop()
        name = _class(e)
        short = name.rsplit(".", 1)[-1]
        if short in _REFUSED_FUNCTIONS or not name.startswith(_EXPRESSIONS):
            raise QueryRefused(f"function {e.prettyName()!r} is not allowed")
        stack += _items(e.children())


def check_plan(plan, views: Collection[str] | None = None) -> None:
    """Raise ``QueryRefused`` if the analysed ``plan`` has something that is not allowed. ``views`` are the
    registered views' names; without them, every temporary view counts as registered."""
    allowed = None if views is None else {v.lower() for v in views}
    stack = [plan]
    while stack:
        node = stack.pop()
        name = _class(node)
        short = name.rsplit(".", 1)[-1]
        if short == "View":
            view = node.desc().identifier().table()
            if not node.isTempView() or (allowed is not None and view.lower() not in allowed):
                raise QueryRefused(f"{view!r} is not a registered view")
            continue
        children = _items(node.children())
        if short in _REFUSED_NODES or not name.startswith(_PLANS):
            what = "a relation that is no registered view" if not children else node.nodeName()
            raise QueryRefused(f"{what} is not allowed")
        if not children and short not in _FREE_LEAVES:
            raise QueryRefused(f"{node.nodeName()} is not allowed")
        for e in _items(node.expressions()):
            _check_function(e)
        stack += children + _items(node.subqueries())


def analysed(df: DataFrame):
    return df._jdf.queryExecution().analyzed()


def has_own_limit(df: DataFrame) -> bool:
    """Whether the query's outermost step is a LIMIT of its own."""
    return analysed(df).nodeName() == "GlobalLimit"
