"""Authors, affiliations and mail addresses of scholarly HTML pages."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

CONTACTS = pa.struct([
    ("emails", pa.list_(pa.string())), ("affiliations", pa.list_(pa.string())),
    ("authors", pa.list_(pa.struct([("name", pa.string()), ("markers", pa.list_(pa.string())), ("affiliations", pa.list_(pa.string()))]))),
])
CONTACTS_SQL = "struct<emails array<string>, affiliations array<string>, authors array<struct<name string, markers array<string>, affiliations array<string>>>>"

# Class names of the markup.
PERSON, NOTE, AFFILIATION, CREATOR = "ltx_personname", "ltx_note", ("ltx_role_affiliation", "ltx_role_address", "ltx_role_institutetext"), "ltx_creator"
MARK, LABEL, FOOTMARK = "ltx_note_mark", ("ltx_note_type", "ltx_tag_note"), "ltx_role_footnotemark"
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset("script style template noscript".split())
#: Ends of these close words.
BLOCKS = frozenset("p div li br td tr h1 h2 h3 h4 section article".split())

MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
GROUP = re.compile(r"\{([^{}@]*)\}\s*@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
#: Notes about the authorship itself name no organisation.
ABOUT_AUTHORS = re.compile(r"\b(equal(ly)?|co-?first|co-?lead|corresponding|correspondence|contribut\w*|work (was )?(done|performed)|supported by|project lead)\b", re.I)
MAIL_LABEL = re.compile(r"\b(e-?mails?|contact)\s*(address(es)?)?\s*:", re.I)


def mails_in(text: str) -> list[str]:
    """Addresses in their order, {a, b}@host as one for each name."""
    found = [(m.start(), f"{name}@{m[2]}") for m in GROUP.finditer(text) for name in LOCAL.findall(m[1])]
    found += [(m.start(), m[0]) for m in MAIL.finditer(GROUP.sub(lambda m: " " * len(m[0]), text))]
    return [mail for _, mail in sorted(found, key=lambda x: x[0])]


def organisation(text: str) -> str | None:
    """What a note or an affiliation says beside mail addresses; None if that is nothing or about the authors."""
    rest = MAIL_LABEL.sub(" ", MAIL.sub(" ", GROUP.sub(" ", text)))
    rest = " ".join(rest.split()).strip(" ,;.:")
    return rest if any(c.isalpha() for c in rest) and not ABOUT_AUTHORS.search(rest) else None


class _Scan(HTMLParser):
    """One pass over a page. Open elements form a stack; a person, note or affiliation takes the text inside
    it. It ends with its element, with any element around it, with the next of its kind, or with the page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, dict | None, str | None]] = []  # tag, what it holds, how its text counts
        self.found: list[dict] = []
        self.text: list[str] = []
        self.group = self.groups = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            self.handle_data(" ")
            return
        given = dict(attrs)
        classes = (given.get("class") or "").split()
        holder, role = None, None
        if tag == "a" and (given.get("href") or "").lower().startswith("mailto:"):
            self.text.append(f" {given['href'][7:].split('?')[0]} ")
        if tag in UNSEEN:
            role = "unseen"
        elif MARK in classes or tag == "sup":
            role = "mark"
        elif any(c in classes for c in LABEL):
            role = "label"
        kind = "person" if PERSON in classes else "affiliation" if any(c in classes for c in AFFILIATION) else "note" if NOTE in classes else None
        if kind:
            if kind != "note":
                self._close_kind(kind)
            holder = {"kind": kind, "parts": [], "group": self.group, "footmark": FOOTMARK in classes}
            self.found.append(holder)
            self.text.append(" ")
        if CREATOR in classes:
            self.groups += 1
            self.group = self.groups
            role = "creator"
        if tag in BLOCKS:
            self.handle_data(" ")
        self.open.append((tag, holder, role))

    def handle_endtag(self, tag: str) -> None:
        if any(t == tag for t, _, _ in self.open):
            while self.open:
                t, holder, role = self.open.pop()
                self.group = 0 if role == "creator" else self.group
                if holder:
                    self.text.append(" ")
                if t == tag:
                    break
        if tag in BLOCKS:
            self.handle_data(" ")

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_data(" ")

    def handle_data(self, data: str) -> None:
        roles = {r for _, _, r in self.open}
        if "unseen" in roles:
            return
        self.text.append(data)
        for i in range(len(self.open) - 1, -1, -1):
            holder = self.open[i][1]
            if holder:
                inside = {r for _, _, r in self.open[i:]}
                holder["parts"].append(("label" if "label" in inside else "mark" if "mark" in inside else "text", data))
                return

    def _close_kind(self, kind: str) -> None:
        """A person inside a person: the first was left open."""
        for i, (_, holder, _) in enumerate(self.open):
            if holder and holder["kind"] == kind:
                del self.open[i:]
                return


def _marks(text: str) -> list[str]:
    return [m for m in re.split(r"[\s,;]+", text.replace("∗", "*")) if m]


def _persons(holder: dict) -> list[dict]:
    """Names of a person element, each with the marks behind it."""
    out: list[dict] = []
    for kind, run in groupby((p for p in holder["parts"] if p[0] != "label"), key=lambda p: p[0]):
        data = "".join(d for _, d in run)
        if kind == "text":
            names = (" ".join(MAIL.sub(" ", piece).split()) for piece in re.split(r",|;|&|\band\b", data))
            out += [{"name": n, "markers": [], "group": holder["group"]} for n in names if any(c.isalpha() for c in n)]
        elif out:
            out[-1]["markers"] += _marks(data)
    return out


def contacts_of(html: str) -> dict:
    """emails, affiliations and authors of a page, each once and in order of appearance."""
    scan = _Scan()
    scan.feed(html)
    scan.close()
    persons: list[dict] = []
    said: list[tuple[str | None, set[str], int]] = []
    for holder in scan.found:
        if holder["kind"] == "person":
            persons += _persons(holder)
            continue
        text = "".join(d if k == "text" else " " for k, d in holder["parts"])
        marks = [m for k, d in holder["parts"] if k == "mark" for m in _marks(d)]
        if holder["footmark"]:
            if persons:
                persons[-1]["markers"] += marks[:1]
        else:
            own = set(marks[:1] if holder["kind"] == "note" else marks)
            said.append((organisation(text), own, holder["group"]))
    authors = []
    for p in persons:
        markers = list(dict.fromkeys(p["markers"]))
        own = [org for org, marks, group in said if org and (marks & set(markers) or (group and group == p["group"]))]
        authors.append({"name": p["name"], "markers": markers, "affiliations": list(dict.fromkeys(own))})
    return {"emails": list(dict.fromkeys(mails_in("".join(scan.text)))), "affiliations": list(dict.fromkeys(o for o, _, _ in said if o)), "authors": authors}


def _contacts(html: pa.Array) -> pa.Array:
    return pa.array([None if x is None else contacts_of(x) for x in html.to_pylist()], CONTACTS)


def html_contacts(html: Column) -> Column:
    """struct(emails, affiliations, authors) of each page; null for null, empty arrays for a page without any.

    A mark behind a name (sup, or a note mark) leads to the notes and affiliations that begin with it;
    affiliations inside the element of one creator are that author's whatever their marks. Pages are
    read whole; tags may be left open, entities are resolved, scripts, styles and comments are no text.
    """
    return F.arrow_udf(_contacts, CONTACTS_SQL)(html)
