import html as h
import random

import pytest

from litfunnel.sources.html_contacts import contacts_of, html_contacts


def person(name, *marks):
    return f'<span class="ltx_personname">{name}' + (f"<sup>{','.join(marks)}</sup>" if marks else "") + "</span>"


def note(mark, text):
    return f'<span class="ltx_note ltx_role_footnotetext"><sup class="ltx_note_mark">{mark}</sup><span class="ltx_note_type">footnotetext: </span>{text}</span>'


def found(page):
    c = contacts_of(page)
    return c["emails"], c["affiliations"], [(a["name"], a["markers"], a["affiliations"]) for a in c["authors"]]


def test_notes_are_paired_with_authors():
    page = person("Ana Li", "1", "2") + person("Jo M&uuml;ller", "2") + person("Al Ode") + note(1, "Inst. of Maps &amp; Roads.") + note(2, " River Lab , ") + note("†", "Equal contribution. Email: {a, b}@x.edu, c@y.org.")
    assert found(page) == (["a@x.edu", "b@x.edu", "c@y.org"], ["Inst. of Maps & Roads", "River Lab"], [("Ana Li", ["1", "2"], ["Inst. of Maps & Roads", "River Lab"]), ("Jo Müller", ["2"], ["River Lab"]), ("Al Ode", [], [])])


def test_inline_affiliations_belong_to_their_creator():
    one = lambda name, org: f'<span class="ltx_creator ltx_role_author">{person(name)}<span class="ltx_author_notes"><span class="ltx_contact ltx_role_affiliation">{org}</span><span class="ltx_contact ltx_role_affiliation">{name[0]}@{org[0]}.edu</span></span></span>'
    assert found(one("Ana", "Xylo U") + one("Bo", "Yak U")) == (["A@X.edu", "B@Y.edu"], ["Xylo U", "Yak U"], [("Ana", [], ["Xylo U"]), ("Bo", [], ["Yak U"])])


def test_several_names_in_one_element():
    page = '<span class="ltx_personname"><b>Ana</b> Li<sup>1</sup>, Bo Sand<sup>2,∗</sup> and Cy Andover &amp; Di Ek</span>' + note(2, "Two Labs")
    assert found(page)[2] == [("Ana Li", ["1"], []), ("Bo Sand", ["2", "*"], ["Two Labs"]), ("Cy Andover", [], []), ("Di Ek", [], [])]


def test_open_tags():
    page = '<div><span class="ltx_personname">Ana<sup>1</sup><span class="ltx_personname">Bo<sup>2</sup></div>' + '<span class="ltx_role_affiliation">Left U<span class="ltx_role_affiliation"><sup>2</sup>Other U<p>Street</i></b> 1<br>'
    assert found(page) == ([], ["Left U", "Other U Street 1"], [("Ana", ["1"], []), ("Bo", ["2"], ["Other U Street 1"])])


def test_what_is_no_text():
    page = '<script>var m = "a@b.com";</script><style>c@d.org</style><!-- e@f.net --><a href="mailto:x@y.org?subject=z">write</a> g&#64;h.io <template>t@t.com</template>' + note(1, "<br/>")
    assert found(page) == (["x@y.org", "g@h.io"], [], [])
    assert found("") == ([], [], []) == found("<") == found("a < b > c </span></div>")


def test_footnote_marks_in_names():
    page = '<span class="ltx_personname">Ana Li<span class="ltx_note ltx_role_footnotemark"><sup class="ltx_note_mark">3</sup><span class="ltx_note_outer"><sup class="ltx_note_mark">3</sup></span></span></span>' + note(3, "Three Labs")
    assert found(page) == ([], ["Three Labs"], [("Ana Li", ["3"], ["Three Labs"])])


@pytest.mark.parametrize("seed", range(20))
def test_generated_pages(spark, seed):
    """Pages written from known authors and notes, with tags left open where that says nothing else."""
    r = random.Random(seed)
    orgs = {str(i): f"{r.choice(['Lab', 'École', 'Œuvre & Co', 'Inst <b'])} {i} {r.choice('XYZ')}" for i in range(r.randint(0, 6))}
    people = [(f"Name{i} Ü{i}", sorted(r.sample(sorted(orgs), r.randint(0, min(3, len(orgs)))))) for i in range(r.randint(0, 5))]
    coded = lambda t: h.escape(t) if r.random() < 0.5 else "".join(f"&#{ord(c)};" for c in t)
    page = "".join(f'<div><span class="ltx_personname">{coded(n)}' + (f"<sup>{','.join(m)}</sup>" if m else "") + r.choice(["</span></div>", "</div>", "</b></span></div>"]) for n, m in people)
    page += "".join(f'<p><span class="ltx_note"><sup class="ltx_note_mark">{k}</sup><i>{coded(v)}' + r.choice(["</i></span></p>", "</p>", "</span>"]) for k, v in orgs.items())
    want = ([], list(orgs.values()), [(n, m, [orgs[k] for k in orgs if k in m]) for n, m in people])
    assert found(page) == want


def test_column(spark):
    pages = [(1, person("Ana", "1") + note(1, "One Lab")), (2, None), (3, ""), (4, "x " * 500_000 + "a@b.org")]
    got = {x.k: x.c for x in spark.createDataFrame(pages, "k long, html string").select("k", html_contacts("html").alias("c")).collect()}
    assert got[2] is None and (got[3].emails, got[3].affiliations, got[3].authors) == ([], [], [])
    assert got[1].authors[0].asDict() == {"name": "Ana", "markers": ["1"], "affiliations": ["One Lab"]} and got[4].emails == ["a@b.org"]
