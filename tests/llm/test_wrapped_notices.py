"""License notices that are wrapped over several lines."""

import textwrap

import pytest

from colonnade.llm import license_scan
from tests.llm.conftest import documents


@pytest.mark.parametrize("width, mark", [(60, ""), (70, "# "), (80, " * ")])
def test_wrapped_notices(spark, width, mark):
    rows, want = [], {}
    for i, (label, notice) in enumerate(license_scan.TEMPLATES):
        lines = textwrap.wrap("Copyright 2001 by somebody who wrote these pages in spring, all rights kept. " + notice + ". Nothing else is said.", width)
        assert len(lines) > 1
        rows.append((i, "\n".join(mark + x for x in lines)))
        want[i] = label
    apart = license_scan.TEMPLATES[4][1].split()
    rows.append((100, ("\n" + "far away " * 20 + "\n").join(apart)))
    out = {r["doc_id"]: r for r in license_scan.scan(documents(spark, rows)).collect()}
    assert len(out) == len(rows)
    for i, label in want.items():
        assert label in out[i]["labels"].split(",") and out[i]["score"] == 1.0, (label, out[i])
    assert out[100]["labels"] == "" and out[100]["score"] == 0.0
