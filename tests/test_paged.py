import shutil
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from litfunnel.operators import ingest
from litfunnel.sources import paged

OPTIONS = {"sets": "cs,stat", "from": "2024-01-01", "until": "2024-01-10"}
WEEKS = (("2024-01-01", "2024-01-07"), ("2024-01-08", "2024-01-10"))


def record(i):
    return f"<record><header><identifier>oai:{i}</identifier></header><metadata><arXiv><id>{i}</id><title>t</title></arXiv></metadata></record>"


def listed(records="", token=None):
    return f"<oai:OAI-PMH><oai:ListRecords>{records}" + (f"<oai:resumptionToken cursor='0'> {token} </oai:resumptionToken>" if token else "") + "</oai:ListRecords></oai:OAI-PMH>"


def failed(code):
    return f'<OAI-PMH><error code="{code}">why</error></OAI-PMH>'


def first(s, week):
    return paged._name("list", s, *WEEKS[week])


@pytest.fixture
def folder(spark, tmp_path):
    paged.register(spark)
    pages = {
        first("cs", 0): listed(record("a") + record("b"), "x&amp;1"), paged._name("token", "x&1"): listed(record("c"), "x2"), paged._name("token", "x2"): listed(record("d")),
        first("cs", 1): failed("noRecordsMatch"), first("stat", 0): listed(record("e")), first("stat", 1): listed(record("f")),
    }
    store(spark, pages, tmp_path / "pages")
    return tmp_path / "pages"


def store(spark, pages, folder):
    paged.store_pages(spark.createDataFrame(list(pages.items()), "name string, xml string"), str(folder))


def load(spark, folder, **more):
    return spark.read.format(paged.FORMAT).options(path=str(folder), **(OPTIONS | more)).load()


def ids(pages):
    return sorted(r.arxiv_id for r in ingest.page_records(pages).collect())


def test_names_agree(spark):
    one = spark.range(1).select(paged.first_page(F.lit("cs"), F.lit("2024-01-01"), F.lit("2024-01-07")), paged.next_page(F.lit("x&1"))).first()
    assert tuple(one) == (first("cs", 0), paged._name("token", "x&1"))


def test_windows():
    got = [(w.set_spec, w.first, w.last) for w in paged.windows_of(["a", "b"], date(2024, 1, 1), date(2024, 1, 8), 7)]
    assert got == [("a", date(2024, 1, 1), date(2024, 1, 7)), ("b", date(2024, 1, 1), date(2024, 1, 7)), ("a", date(2024, 1, 8), date(2024, 1, 8)), ("b", date(2024, 1, 8), date(2024, 1, 8))]


def test_tokens_are_followed(spark, folder):
    pages = load(spark, folder)
    assert pages.rdd.getNumPartitions() == 4
    assert ids(pages) == list("abcdef")
    assert sorted((r.set_spec, str(r.window_from), r.page) for r in pages.collect()) == [("cs", "2024-01-01", 1), ("cs", "2024-01-01", 2), ("cs", "2024-01-01", 3), ("stat", "2024-01-01", 1), ("stat", "2024-01-08", 1)]


@pytest.mark.parametrize("name, page, told", [("x2", failed("badResumptionToken"), "error code=badResumptionToken message=why"), ("x2", None, "page 3 is missing"), ("x2", listed("", "x&amp;1"), "a token leads back to an earlier page")])
def test_failures(spark, folder, name, page, told):
    file = folder / paged._name("token", name)
    file.write_text(page) if page else file.unlink()
    with pytest.raises(PySparkException, match=told):
        load(spark, folder).collect()
    kept = load(spark, folder, failures="keep")
    assert [(r.set_spec, str(r.window_from), r.page, r.xml, r.failure) for r in kept.where("failure IS NOT NULL").collect()] == [("cs", "2024-01-01", None, None, told)]
    assert ids(kept) == ["e", "f"]


def test_stream_goes_on_from_its_checkpoint(spark, folder, tmp_path):
    late = {w: (folder / first("stat", w)) for w in (0, 1)}
    for w, f in late.items():
        shutil.move(f, tmp_path / f"late{w}")

    def run():
        stream = spark.readStream.format(paged.FORMAT).options(path=str(folder), **OPTIONS).load()
        q = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
        assert q.awaitTermination(120)
        return ids(spark.read.schema(paged.PAGES).parquet(str(tmp_path / "out")))

    assert run() == list("abcd")
    shutil.move(tmp_path / "late1", late[1])
    assert run() == list("abcd")  # the window before it isn't there yet
    shutil.move(tmp_path / "late0", late[0])
    assert run() == list("abcdef")
    assert run() == list("abcdef")


def test_pages_written_from_rows_are_read_back(spark, tmp_path):
    paged.register(spark)
    rows = [(s, date(2024, 1, 1), date(2024, 1, 7), i, record(f"{s[0]}{i}")) for s in ("cs", "a&<b") for i in range(7)]
    made = paged.pages_of(spark.createDataFrame(rows, "s string, a date, b date, i long, r string"), "s", ("a", "b"), "i", "r", 3)
    assert made.count() == 6
    paged.store_pages(made, str(tmp_path / "p"))
    got = load(spark, tmp_path / "p", sets="cs,a&<b", until="2024-01-07")
    assert got.count() == 6 and len(ids(got)) == 14
