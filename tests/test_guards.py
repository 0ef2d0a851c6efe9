"""Source-level guards: the library keeps away from patterns that put a whole group in one
task, that cannot survive a lost executor, or that leave the JVM row by row."""

import pathlib
import re

LIBRARY = pathlib.Path(__file__).resolve().parent.parent / "statmart"

FORBIDDEN = {
    r"\blocalCheckpoint\b": "lineage must be cut with checkpoint() or a written table",
    r"\bcollect_(list|set)\b": "gathers a whole group into one task",
    r"\bF\.(percentile|median)\(": "exact percentile buffers a whole group in one task",
    r"@F\.udf|\budf\(": "row-at-a-time Python UDF",
    r"\bmapInPandas\b": "Python in the engine's own operators",
    r"\.rdd\b|mapPartitions\(": "RDD API instead of DataFrames",
}


def test_library_avoids_single_task_and_row_patterns():
    found = []
    for path in LIBRARY.rglob("*.py"):
        text = path.read_text(encoding="utf-8")
        for pattern, why in FORBIDDEN.items():
            for m in re.finditer(pattern, text):
                line = text.count("\n", 0, m.start()) + 1
                found.append(f"{path.name}:{line} {m.group(0)} ({why})")
    assert not found, "\n".join(found)
