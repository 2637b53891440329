"""Hand-written docstrings: the parse job against results worked out by hand
from the parse rules (sections, consumed line after a header, first-entry
indent, continuation folding, key cleaning / filtering / expansion)."""

import pytest

from colonnade.corpus import docstrings as D

CASES = {
    # entries at indent 0, continuation lines, a blank line inside
    1: ("numpy", """Summary.

Parameters
----------
x : int
    First line,
    second line.

    After blank.
y : str
    Why.

Returns
-------
z : float
    ignored""",
        {"param": {"x": "int First line, second line.  After blank.", "y": "str Why."}, "attr": {}}),
    # key forms (non-combining library)
    2: ("numpy", """Parameters
----------
x (int) : first
(a, b) : pair
{c,d}_x : brace
e, f : comma
*args : star
g.h : dotted
k[0] : indexed
two words : spaced""",
        {"param": {"x": "first", "a": "pair", "b": "pair", "c_x": "brace", "d_x": "brace", "e": "comma", "f": "comma"},
         "attr": {}}),
    # the combining library joins "(a, b)" into a_and_b
    3: ("scipy", """Parameters
----------
(a, b) : pair
n : count""",
        {"param": {"a_and_b": "pair", "n": "count"}, "attr": {}}),
    # the same key twice; the same key as parameter and attribute
    4: ("numpy", """Parameters
----------
p : one
q : two
p : three
Attributes
----------
q : attr_q
r_ : attr_r""",
        {"param": {"p": "three", "q": "two"}, "attr": {"q": "attr_q", "r_": "attr_r"},
         "pa": {"p": "three", "q": "attr_q", "r_": "attr_r"}}),
    # text between header and first entry; an entry line without colon
    6: ("numpy", """Parameters
----------
Some intro text
x : int
    cont
line without colon at indent 0
y : str""",
        {"param": {"x": "int cont line without colon at indent 0", "y": "str"}, "attr": {}}),
    # two headers in a row: the second is consumed, the section stays closed
    7: ("numpy", """Parameters
----------
a : one
Notes
Attributes
----------
b : two""",
        {"param": {"a": "one"}, "attr": {}}),
    # three headers in a row: first and third count
    8: ("numpy", """Parameters
----------
a : one
Notes
Attributes
Parameters
----------
b : two""",
        {"param": {"a": "one", "b": "two"}, "attr": {}}),
    # entries at indent 4; a deeper line with a colon continues the entry
    9: ("numpy", """Parameters
----------
    x : int
        deeper : not a key
    y : str""",
        {"param": {"x": "int deeper : not a key", "y": "str"}, "attr": {}}),
    # spaces around commas are normalized
    10: ("numpy", """Parameters
----------
t : {'a' ,'b'}  ,  default 'a'""",
         {"param": {"t": "{'a', 'b'}, default 'a'"}, "attr": {}}),
}
# attributes without parameters: no output; a document ending in a header: no output
SILENT = {
    5: ("numpy", """Attributes
----------
a_ : attr only"""),
    11: ("numpy", """Parameters
----------
a : one
Notes"""),
}


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(k, lib, text) for k, (lib, text, _) in CASES.items()] + \
        [(k, lib, text) for k, (lib, text) in SILENT.items()]
    docs = spark.createDataFrame(rows, "doc_id long, lib string, text string")
    final = D.parse(docs)["final"].collect()
    out = {}
    for r in final:
        out.setdefault(r["doc_id"], {}).setdefault(r["kind"], {})[r["key"]] = r["value"]
    return out


@pytest.mark.parametrize("doc_id", sorted(CASES))
def test_case(parsed, doc_id):
    _, _, want = CASES[doc_id]
    got = parsed.get(doc_id, {})
    assert got.get("param", {}) == want["param"]
    assert got.get("attr", {}) == want["attr"]
    pa = want.get("pa", {**want["param"], **want["attr"]})
    assert got.get("pa", {}) == pa


@pytest.mark.parametrize("doc_id", sorted(SILENT))
def test_silent(parsed, doc_id):
    assert doc_id not in parsed


def test_doc_gate(spark):
    docs = spark.createDataFrame([(1, "x", "Parameters\n-----\na : b"), (2, "x", "Params\na : b")],
                                 "doc_id long, lib string, text string")
    assert [r[0] for r in D.doc_gate(docs).select("doc_id").collect()] == [1]


def test_single_exchange(spark):
    """The whole parse shares one shuffle on doc_id, and it moves entries, not texts."""
    docs = spark.createDataFrame([(1, "numpy", CASES[1][1])], "doc_id long, lib string, text string")
    plan = D.parse(docs)["final"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange hashpartitioning") < plan.index("MapInArrow")  # above the parse
