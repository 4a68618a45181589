"""Plan checks: read the physical plan a DataFrame compiles to (the text of
``explain``) and answer the questions the tests and the benchmark ask about
it: which scans, which pushed filters, which operators, any Python UDF."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "MapInPandas", "FlatMapCoGroupsInPandas", "PythonUDF")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def _tree(text: str) -> str:
    """The operator tree; for an executed adaptive plan, its final part."""
    tree = text.split("\n\n")[0]
    return tree.split("== Initial Plan ==")[0]


def final_tree(df: DataFrame) -> str:
    """The operator tree of ``df``'s plan (the final plan once executed)."""
    return _tree(plan_text(df))


def _tree_ids(text: str) -> set[str]:
    return set(re.findall(r"\((\d+)\)", _tree(text)))


def operator_count(df: DataFrame, name: str) -> int:
    """How many physical nodes named ``name`` the (final) plan tree has."""
    return len(re.findall(rf"\b{re.escape(name)}\b", _tree(plan_text(df))))


def scans(df: DataFrame) -> list[dict[str, str]]:
    """Scan nodes with their location, pushed filters, partition filters and
    read schema."""
    out = []
    text = plan_text(df)
    ids = _tree_ids(text)
    main = text.split("===== Subqueries =====")[0]
    for block in main.split("\n\n"):
        lines = block.strip().splitlines()
        m = re.match(r"\((\d+)\) Scan ", lines[0]) if lines else None
        if not m or m.group(1) not in ids:
            continue
        info = {"node": lines[0].strip()}
        for line in lines[1:]:
            if ":" in line:
                k, v = line.split(":", 1)
                info[k.strip()] = v.strip()
        out.append(info)
    return out


def python_nodes(df: DataFrame) -> list[str]:
    text = plan_text(df, "extended")
    return [n for n in PYTHON_NODES if n in text]
