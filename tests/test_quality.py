from litfunnel.operators import quality

SCREEN = "content_item_id long, at string, id long, technical_significance double, apparent_novelty double, evidence_strength double, passed boolean"


def chosen(spark, screens, links=(), orgs=(), wrote=(), people=(), percent=25):
    d = lambda rows, schema: spark.createDataFrame(list(rows), schema)
    got = quality.quality_candidates(
        d(screens, SCREEN), d(links, "content_item_id long, organisation_id long"), d(orgs, "organisation_id long, is_org_of_interest boolean, active boolean"),
        d(wrote, "content_item_id long, person_id long"), d(people, "person_id long, is_person_of_interest boolean, active boolean"), percent=percent,
    )
    return {r.content_item_id: r.routes for r in got.collect()}


def test_three_routes(spark):
    screens = [(i, "t1", i, float(i), 5.0, 5.0, True) for i in range(1, 9)]
    screens += [(9, "t1", 9, 9.0, None, 9.0, True), (10, "t1", 10, 9.0, 9.0, 9.0, False), (1, "t2", 20, 9.0, 9.0, 9.0, True), (8, "t2", 21, 9.0, 9.0, 9.0, None)]
    links = [(2, 1), (2, 1), (3, 2), (4, 3), (10, 1), (9, 1), (7, None)]
    orgs = [(1, True, True), (2, True, False), (3, None, True), (None, True, True)]
    wrote, people = [(5, 1), (2, 1), (6, 2)], [(1, True, True), (2, False, True)]
    # Seven survivors have a mean: a quarter of them is 1.75, so two.
    assert chosen(spark, screens, links, orgs, wrote, people) == {1: "top", 7: "top", 2: "org,person", 9: "org", 5: "person"}


def test_ties_and_none(spark):
    tied = [(i, "t", i, 5.0, 5.0, 5.0, True) for i in range(10)]
    assert chosen(spark, tied) == {0: "top", 1: "top"}  # 2.5 is rounded to the even number
    assert chosen(spark, tied[:1], percent=1) == {0: "top"}
    assert chosen(spark, []) == {}
    assert chosen(spark, [(1, "t", 1, 5.0, 5.0, 5.0, False)]) == {}
