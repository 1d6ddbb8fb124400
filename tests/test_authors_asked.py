from pyspark.sql import functions as F

from litfunnel.functions import text
from litfunnel.operators import authors


def test_only_names_of_asked_papers_are_read_and_each_once(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def forms(name):
        read.add(1)
        return [name.lower()]

    monkeypatch.setattr(text, "name_forms", forms)
    people = spark.range(600).select((F.col("id") % 200).alias("paper"), F.floor(F.col("id") / 200).cast("int").alias("author_position"), F.concat(F.lit("Ada N"), F.col("id") % 7).alias("normalized_name"))
    names = spark.createDataFrame([(i, "ADA N3") for i in range(20)] + [(3, "ADA N3"), (5, None), (None, "Ada N1")], "paper long, name string")
    got = authors.author_of_name(names, people, "paper").collect()
    assert 0 < read.value <= 9
    own = {}
    for x in people.where("normalized_name = 'Ada N3'").collect():
        own[x.paper] = min(own.get(x.paper, 9), x.author_position)
    one = lambda x: (x.paper, x.name, x.author_position)
    surname = {x.paper for x in got if x.author_position is None}
    expected = [(x.paper, x.name, own.get(x.paper) if x.name == "ADA N3" else None) for x in names.collect()]
    assert sorted(map(str, map(one, got))) == sorted(map(str, expected)) and None in surname


def test_mails_read_only_names_of_their_papers(spark):
    people = spark.createDataFrame([(1, 1, "Bob Stone"), (1, 2, "Ada Jones"), (2, 1, "Ada Jones"), (None, 1, "Ada Jones")], "paper long, author_position int, normalized_name string")
    mails = spark.createDataFrame([(1, "ada.jones@x.org"), (1, "ada.jones@x.org"), (3, "ada@x.org"), (None, "ada@x.org")], "paper long, email string")
    got = sorted(map(str, (tuple(x) for x in authors.author_of_mail(mails, people, "paper").collect())))
    assert got == sorted(map(str, [(1, "ada.jones@x.org", 2)] * 2 + [(3, "ada@x.org", None), (None, "ada@x.org", None)]))
