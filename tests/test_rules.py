"""What the engine's own source must not contain."""

import pathlib
import re

import pytest

ROOT = pathlib.Path(__file__).parent.parent
# The event engine; the text operators beside it may use Arrow batches where they say so.
SOURCES = sorted(
    p
    for folder in ("eventmill", "workload")
    for p in (ROOT / folder).rglob("*.py")
    if (ROOT / "eventmill" / "llm") not in p.parents
)


@pytest.mark.parametrize("path", SOURCES, ids=lambda p: str(p.relative_to(ROOT)))
def test_no_rows_in_python(path):
    text = path.read_text()
    for word in (r"\budf\(", "pandas", r"\.rdd\b", r"\.collect\(\)", "toPandas", "localCheckpoint", "crossJoin", r"\.cache\(", r"\.persist\("):
        assert not re.search(word, text), word
