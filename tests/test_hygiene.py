"""Source-level guards for the library's rules."""

from __future__ import annotations

import pathlib
import re

import pytest

PKG = pathlib.Path(__file__).resolve().parent.parent / "ordersight"


def _sources(*parts: str):
    for part in parts:
        yield from (PKG / part).rglob("*.py")


def test_no_local_checkpoint_or_python_udfs():
    for path in PKG.rglob("*.py"):
        if "llm" in path.relative_to(PKG).parts:  # free in style, has its own tests
            continue
        text = path.read_text()
        for banned in ("localCheckpoint", "pandas_udf", "F.udf", "@udf", "mapInPandas", "applyInPandas"):
            assert banned not in text, f"{banned} in {path}"


def test_no_plan_time_runs_or_hand_made_distribution():
    """Nothing may execute joins while a plan is built, move files lists to Python, or repartition on a key."""
    for path in _sources("operators", "plans", "sources", "functions", "streaming", "sinks"):
        text = path.read_text()
        for banned in (".rdd", "inputFiles", "mkdtemp", "broadcast(", "load_cap"):
            assert banned not in text, f"{banned} in {path}"
        for call in re.findall(r"\.repartition\(([^)]*)\)", text):
            assert "," not in call and '"' not in call, f"keyed repartition in {path}"


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from ordersight import session

    class Cluster:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(session.NoSharedFolder):
        session.checkpoint_root(Cluster)


def test_operators_plans_sources_never_pull_rows_to_the_driver():
    for path in _sources("operators", "plans", "sources", "functions", "streaming"):
        text = path.read_text()
        for banned in (".collect()", ".toPandas()", ".toLocalIterator("):
            assert banned not in text, f"{banned} in {path}"
