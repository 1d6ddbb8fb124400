"""The tiers of affiliation evidence on papers made for each rule."""

import pytest
from pyspark.sql import functions as F

from litfunnel.operators import affiliation, affiliation_stage

PAPER = "line long, affiliation_text array<string>, emails array<string>, place string"
AUTHOR = "line long, author_position int, normalized_name string"
REGISTRY = "query string, place int, org_name string, ror_id string, aliases array<string>, acronyms array<string>, domains array<string>, score double"
WORK = "line long, author_name string, institution_name string, ror_id string, openalex_id string, raw_affiliations array<string>"


def cascade(spark, papers, authors, registry=(), works=(), pages=None, mode="deep", orgs=None, aliases=None):
    """The key column is named like a helper of the stage on purpose."""
    o = spark.createDataFrame(orgs or [(1, "River University", None, None), (2, "Sea Lab", None, None)], "org_id long, canonical_name string, ror_id string, openalex_id string")
    a = spark.createDataFrame(aliases or [(1, "RU", "abbreviation"), (1, "river.edu", "domain"), (2, "sea.org", "domain")], "org_id long, alias string, alias_type string")
    p = spark.createDataFrame([(k, x, y, "clash") for k, x, y in papers], PAPER)
    found = affiliation_stage.affiliation_cascade(p, spark.createDataFrame(authors, AUTHOR), o, a, "line", spark.createDataFrame(list(registry), REGISTRY), spark.createDataFrame(list(works), WORK), None if pages is None else spark.createDataFrame([(*x, "y") for x in pages], PAPER), mode)
    names = {r.org_id: r.canonical_name for r in o.unionByName(found.created, allowMissingColumns=True).collect()}
    rows = [(r.line, r.author_position, names.get(r.org_id), r.evidence_type.split("_")[0], r.evidence_value, r.confidence, r.scope.split("_")[0]) for r in found.rows.collect()]
    assert len(rows) == len(set(rows))
    return set(rows), found


TWO = [(k, i, n) for k in range(1, 30) for i, n in ((1, "Ada Jones"), (2, "Bo Chen"))]


def test_discount_rounds_ties_down(spark):
    got = spark.createDataFrame([(0.85,), (0.75,), (0.9,), (0.5,), (0.725,), (0.8,)], "c double").select(affiliation_stage.shared_confidence(F.col("c"))).collect()
    assert [x[0] for x in got] == [0.637, 0.562, 0.675, 0.375, 0.544, 0.6]


def test_names_and_mails(spark):
    papers = [
        (1, ["Affiliation: River University, Someplace", "AFFILIATION: river university, someplace"], None),
        (2, None, ["ada.jones@cs.river.edu", "bo.chen@cs.river.edu"]),  # the first mail of a domain decides
        (3, ["Email: {ada, bo}@river.edu", "Contact zed@sea.org"], ["someone@gmail.com"]),
        (4, ["Quiet Institute of Bees", "quiet institute of bees", "Authors: Ada Jones", "Thanks: everyone"], []),
        (5, None, None),
        (6, ["RU, dept. of tides"], ["x@nowhere.example"]),
        (7, ["A" + "a" * 700 + " University"], None),
        (99, ["River University"], None),  # nobody's paper
        (30, ["River University", "Lone College"], ["ada@sea.org"]),  # one author
        (31, ["River University"], ["many.one@sea.org"]),  # more authors than any line can stand for
    ]
    authors = TWO + [(30, 1, "Cy Dee")] + [(31, i, "Many One" if i == 60 else f"P{i} Q") for i in range(1, 61)]
    got, _ = cascade(spark, papers, authors, mode="fast")
    both = lambda k, *row: {(k, i, *row) for i in (1, 2)}
    assert {r for r in got if r[0] == 1} == both(1, "River University", "explicit", "River University", 0.637, "paper")
    assert {r for r in got if r[0] == 2} == {(2, 1, "River University", "email", "cs.river.edu", 0.9, "author")}
    # zed@sea.org is a mail in a line, {ada, bo}@river.edu a group of addresses.
    assert {r for r in got if r[0] == 3} == both(3, "River University", "email", "river.edu", 0.562, "paper") | both(3, "Sea Lab", "email", "sea.org", 0.562, "paper")
    assert {r for r in got if r[0] == 4} == both(4, None, "explicit", "Quiet Institute of Bees", 0.375, "unresolved")
    assert not [r for r in got if r[0] in (5, 99)]
    assert {r for r in got if r[0] == 6} == both(6, None, "explicit", "RU, dept. of tides", 0.375, "unresolved") or {r[2] for r in got if r[0] == 6} == {"River University"}
    assert {len(r[4]) for r in got if r[0] == 7} == {500}
    assert {r for r in got if r[0] == 30} == {(30, 1, "River University", "explicit", "River University", 0.85, "author"), (30, 1, "Sea Lab", "email", "sea.org", 0.75, "author"), (30, 1, None, "explicit", "Lone College", 0.5, "unresolved")}
    assert {r for r in got if r[0] == 31} == {(31, 60, "Sea Lab", "email", "sea.org", 0.9, "author")}


def test_lookups_works_and_pages(spark):
    record = lambda q, name, score=1.0, place=0, **more: (q, place, name, more.get("ror"), more.get("aliases", []), more.get("acronyms", []), more.get("domains", []), score)
    registry = [
        record("Bee College", "Bee College", ror="b1", domains=["bee.example.org"], acronyms=["BC"]), record("Fog College", "Fog College", ror="f1"), record("Fog College", "Rain College", place=1),
        record("Hut College", "Moon", 0.9), record("Ice College", "Ice College", 0.4), record("Jam College", "Jam College", 0.5),
    ]
    papers = [
        (1, ["Hut College; Bee College", "Ice College; Jam College"], ["x@bee.example.org"]),  # two look-ups, then the third is refused: no fourth
        (2, ["Bee College; Hut College", "Ice College; Jam College"], None),  # one, two: within three
        (3, ["River University", "Fog College"], None),  # a known line asks for nothing, the other one does
        (4, ["Elm College of Trees"], None), (5, None, None), (6, ["Sea Lab"], None), (7, None, None), (8, None, None), (9, None, ["q@sea.org"]),
    ]
    works = [
        (4, "Jones, Ada", "Elm College of Trees", None, "w4", []),  # named by the paper's own line
        (5, "Chen, Bo", "Oak Institute", "o1", None, ["Dept of Wood, Oak Institute"]), (5, "Zoe Nobody", "Ash Institute", "a1", None, None), (5, None, "Not Grounded", None, None, ["elsewhere"]),
        (6, "Ada Jones", "Oak Institute", "o1", None, ["Oak Institute"]),  # already resolved
        (98, "Ada Jones", "Oak Institute", "o1", None, ["Oak Institute"]),
    ]
    pages = [(7, ["River University"], None), (9, ["River University"], None), (8, None, ["ada.jones@river.edu"])]
    got, found = cascade(spark, papers, TWO, registry, works, pages)
    of = lambda k: {r[1:] for r in got if r[0] == k}
    both = lambda *row: {(i, *row) for i in (1, 2)}
    bee = both("Bee College", "ror", "Bee College", 0.637, "paper") | both("Bee College", "explicit", "Bee College", 0.637, "paper")
    assert of(1) == bee | both("Bee College", "email", "bee.example.org", 0.562, "paper") | both(None, "explicit", "Ice College", 0.375, "unresolved")
    assert of(2) == bee | both("Jam College", "ror", "Jam College", 0.544, "paper") | both("Jam College", "explicit", "Jam College", 0.637, "paper")
    assert of(3) == both("River University", "explicit", "River University", 0.637, "paper") | both("Fog College", "ror", "Fog College", 0.637, "paper") | both("Fog College", "explicit", "Fog College", 0.637, "paper")
    elm = "Elm College of Trees"
    assert of(4) == {(1, elm, "openalex", elm, 0.85, "author")} | both(elm, "explicit", elm, 0.637, "paper")
    assert of(5) == {(2, "Oak Institute", "openalex", "Oak Institute", 0.85, "author")} | both("Ash Institute", "openalex", "Ash Institute", 0.45, "paper")
    assert of(6) == both("Sea Lab", "explicit", "Sea Lab", 0.637, "paper")
    assert of(7) == both("River University", "explicit", "River University", 0.637, "paper") and of(8) == {(1, "River University", "email", "river.edu", 0.9, "author")}
    assert of(9) == both("Sea Lab", "email", "sea.org", 0.562, "paper")
    learned = {(r.alias, r.alias_type) for r in found.aliases.where("org_id < 0").collect()}
    assert {("Bee College", "name"), ("BC", "abbreviation"), ("bee.example.org", "domain")} <= learned
    # The fast way looks nothing up and keeps the lines as they are.
    fast, _ = cascade(spark, papers, TWO, registry, works, pages, mode="fast")
    assert {r[1:] for r in fast if r[0] == 2} == both(None, "explicit", "Bee College", 0.375, "unresolved") | both(None, "explicit", "Ice College", 0.375, "unresolved")
    with pytest.raises(ValueError, match="mode"):
        cascade(spark, papers, TWO, mode="slow")


def test_no_papers(spark):
    got, _ = cascade(spark, [], TWO[:2])
    assert got == set()
