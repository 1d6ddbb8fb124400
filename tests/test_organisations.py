"""New organisations as clusters of mentions, watch-list seeding and connected components, against plain Python."""

import random

import pytest

from litfunnel.operators import organisations
from litfunnel.operators.graph import connected_components

MENTION = "k long, name string, ror_id string, openalex_id string, tier string"
ORG = "org_id long, canonical_name string, ror_id string, openalex_id string, priority int"
ALIAS = "org_id long, alias string, alias_type string"


def classes(links):
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return {x: root(x) for x in list(parent)}


@pytest.mark.parametrize("shape", ["random", "chain", "star"])
def test_components(spark, shape):
    r = random.Random(3)
    links = {"random": [(r.randrange(150), r.randrange(150)) for _ in range(110)], "chain": [(i, i + 1) for i in range(200)], "star": [(0, i) for i in range(300)]}[shape]
    df = spark.createDataFrame([*links, *links[:5], (7, None), (None, None)], "a long, component long").repartition(5)
    got = {x.node: x.component for x in connected_components(df, "a", "component").collect()}
    linked = [(a, b) for a, b in links if a != b]
    assert got == classes(linked)


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([(1, 1), (None, 2)], "u long, v long"), "u", "v").count() == 0


def test_new_organisations_share_any_key(spark):
    orgs = spark.createDataFrame([(1, "Known Lab", None, "w1", 0), (2, "Second", "r2", None, 0)], ORG)
    aliases = spark.createDataFrame([(2, "Deux", "name"), (2, "x.org", "domain")], ALIAS)
    rows = [
        (1, "Alpha", "r9", None), (2, "Beta", "r9", None), (3, " beta ", None, "w7"), (4, "Gamma", None, "w7"),  # one, through r9, beta and w7
        (5, "Delta", None, None), (6, "DELTA", "", "  "), (7, "X.org", None, None),  # aliases of any kind are names
        (8, "known lab", "r5", "w99"), (9, "Elsewhere", "r5", None), (10, "Nowhere", None, "w99"),  # teaches r5; its organisation has an OpenAlex id already
        (11, "deux", "r8", None), (12, "Other", "r8", None), (13, "Second", None, None), (14, "z", "r2", "w1"), (15, None, "r9", None), (16, " ", "r9", None), (17, "Z", None, None),
    ]
    m = spark.createDataFrame([(*r, "x") for r in rows] + [(1, "Alpha", "r9", None, "x")], MENTION).repartition(4)
    out = organisations.resolved(m, orgs, aliases, "k").collect()
    got = {x.k: (x.org_id, x.matched_by) for x in out}
    assert len(out) == 16 and set(got) == {*range(1, 15), 17}
    assert got[1] == got[2] == got[3] == got[4] and got[1][0] < 0 and got[1][1] == "created"
    assert got[5] == got[6] != got[1] and got[7] == (2, "alias") and got[10][1] == "created"
    assert got[8] == (1, "name") and got[9] == (1, "linked")
    # Its organisation has a ROR id, so r8 teaches nothing.
    assert got[11] == (2, "alias") and got[12][1] == "created" and got[13] == (2, "name") and got[14] == (2, "ror") and got[17] == (2, "linked")
    new = {x.org_id: (x.canonical_name, x.ror_id, x.openalex_id) for x in organisations.created(m, organisations.resolved(m, orgs, aliases, "k"), "k").collect()}
    assert new[got[1][0]] == ("Alpha", "r9", "w7") and new[got[5][0]] == ("Delta", None, None) and len(new) == 4
    names = {(x.org_id, x.alias) for x in organisations.learned_aliases(m, organisations.resolved(m, orgs, aliases, "k"), aliases, "k").collect()}
    assert {(got[1][0], a) for a in ("Alpha", "Beta", "beta", "Gamma")} <= names and (2, "x.org") in names


def test_clusters_against_union_find(spark):
    r = random.Random(11)
    pick = lambda kind, n: r.choice([None, "", *(f"{kind}{i}" for i in range(n))])
    rows = [(i, f"Name {r.randrange(40)}", pick("r", 25), pick("w", 25)) for i in range(90)]
    m = spark.createDataFrame([(*x, "t") for x in rows], MENTION).repartition(6)
    got = {x.k: (x.org_id, x.matched_by) for x in organisations.resolved(m, spark.createDataFrame([], ORG), spark.createDataFrame([], ALIAS), "k").collect()}
    want = classes([(("0", k), (kind, v.lower())) for k, *values in rows for kind, v in zip(("1n", "1r", "1w"), values, strict=True) if v])
    assert set(got) == {k for k, *_ in rows} and all(how == "created" for _, how in got.values())
    assert all((got[a][0] == got[b][0]) == (want["0", a] == want["0", b]) for a in got for b in got)


def test_seeding_twice_changes_nothing(spark):
    orgs = spark.createDataFrame([(1, "Known Lab", None, None, 1)], ORG)
    aliases = spark.createDataFrame([(1, "KL", "name")], ALIAS)
    entries = [(0, "known lab", 3, "r1", None, ["KL", "K-Lab", " "], ["@K.org."]), (1, "New One", 2, None, "w5", None, ["new.org"]), (2, "New 1", 1, None, "w5", [], None), (3, None, 1, "r7", None, [], [])]
    w = spark.createDataFrame(entries, "entry int, name string, priority int, ror_id string, openalex_id string, aliases array<string>, domains array<string>")
    first, names = organisations.seeded(w, orgs, aliases)
    rows = {x.canonical_name: x for x in first.collect()}
    assert set(rows) == {"Known Lab", "New One"} and rows["Known Lab"].ror_id == "r1" and rows["Known Lab"].priority == 3
    assert rows["New One"].openalex_id == "w5" and rows["New One"].priority == 2 and rows["New One"].is_org_of_interest and rows["New One"].org_id < 0
    said = {(x.alias, x.alias_type) for x in names.collect()}
    assert said == {("KL", "name"), ("known lab", "name"), ("K-Lab", "name"), ("k.org", "domain"), ("New One", "name"), ("New 1", "name"), ("new.org", "domain")}
    again, more = organisations.seeded(w, first.drop("is_org_of_interest"), names)
    assert sorted(map(str, again.collect())) == sorted(map(str, first.collect())) and sorted(map(str, more.collect())) == sorted(map(str, names.collect()))
