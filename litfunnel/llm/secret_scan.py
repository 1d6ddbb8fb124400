"""Secret scanning: fixed credential patterns, and a battery of randomness tests for the rest.

Strings of 20 or more credential characters, and their parts between separators, are candidates
where no pattern covers them. For each, the narrowest encoding that holds its characters is
inferred, and three tests ask whether it can be a random string of that encoding: chi-squared
uniformity over the alphabet, the number of runs about its middle, and lag-1 serial correlation.
Each gives a p-value that is uniform for random strings; Fisher's method combines them.

Two decisions by Benjamini-Hochberg follow, each by length class over all candidates:
- those whose combined p-value is rejected aren't random, so that of true random keys about
  RANDOM_LOST are lost at most, whatever their length;
- the rest must be unlike prose: the likelihood ratio of the encoding against the corpus's own
  character frequencies bounds the chance that prose gives such a string, P(ratio >= r) <= 1 / r.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litfunnel.llm.common import slices, staged, texts_of

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
#: A text without any of these can't hold an assignment.
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
PART = re.compile(r"[A-Za-z0-9]{20,}")
#: What a text must hold for an assignment, and for any other span. An access key of 16 characters is no run of 20.
ASSIGN_START = r"(?i)passw|secret|token|api|akia"
RUN = r"[A-Za-z0-9+/_-]{20}"

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: From narrow to wide; the first that holds every character is taken.
ENCODINGS = {
    "decimal": DIGITS,
    "hex": DIGITS + "abcdef",
    "hex_upper": DIGITS + "ABCDEF",
    "lower": LOWER,
    "upper": UPPER,
    "base32": UPPER + "234567",
    "base36": DIGITS + LOWER,
    "base62": DIGITS + UPPER + LOWER,
    "base64": DIGITS + UPPER + LOWER + "+/",
    "base64url": DIGITS + UPPER + LOWER + "_-",
    "mixed": DIGITS + UPPER + LOWER + "+/_-",
}
CREDENTIAL_BYTES = np.frombuffer(ENCODINGS["mixed"].encode(), np.uint8)

FALSE_DISCOVERY_RATE, RANDOM_LOST = 0.001, 0.01
LEAST_LENGTH = 20
#: Covariance of -2 log p of two two-sided tests whose normal scores correlate with 3 / 4.
SHARED = 2.25
#: Bins of -log p of the battery and of nats against prose.
BINS_PER_NAT, TOP_NATS = 4, 200
#: nats of 1 - RANDOM_LOST and more lie in the first bins of the battery, finely cut.
BATTERY_BINS_PER_NAT, BATTERY_TOP = 10, 40


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping within a kind."""
    spans = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return spans


def encoding_of(string: str) -> str:
    held = set(string)
    return next(name for name, alphabet in ENCODINGS.items() if held <= set(alphabet))


def two_sided(z: float) -> float:
    """P(|Z| >= |z|)."""
    return math.erfc(abs(z) / math.sqrt(2))


def upper_tail(z: float) -> float:
    """P(Z >= z)."""
    return math.erfc(z / math.sqrt(2)) / 2


def battery(string: str, alphabet: str) -> tuple[float, float, float]:
    """p-values of uniformity, runs and serial correlation under the hypothesis that string is random over alphabet."""
    n, k = len(string), len(alphabet)
    place = {c: i for i, c in enumerate(alphabet)}
    x = np.array([place[c] for c in string])
    chi2 = float((np.bincount(x, minlength=k) ** 2).sum()) * k / n - n
    # A gamma law of the statistic's own mean and variance, which strings shorter than their
    # alphabet need, by Wilson and Hilferty's cube root.
    mean, variance = k - 1, 2 * (k - 1) * (n - 1) / n
    scale = variance / (9 * mean * mean)
    uniformity = upper_tail(((max(chi2, 1e-9) / mean) ** (1 / 3) - (1 - scale)) / math.sqrt(scale))
    high = x >= k / 2
    a, b = int(high.sum()), int((~high).sum())
    runs = 1.0
    if a and b:
        expected = 2 * a * b / n + 1
        spread = math.sqrt(max((expected - 1) * (expected - 2) / (n - 1), 1e-9))
        runs = two_sided((1 + int((high[1:] != high[:-1]).sum()) - expected) / spread)
    elif n > 1:
        runs = 2.0 ** (1 - n)
    y = x - x.mean()
    power = float((y * y).sum())
    # Of a shuffled string the lag-1 correlation has mean -1 / n and a variance near 1 / n.
    serial = two_sided((float((y[1:] * y[:-1]).sum()) / power + 1 / n) * n / math.sqrt(max(n - 2, 1))) if power else 2.0 ** (1 - n)
    return uniformity, runs, serial


def not_random(string: str, alphabet: str) -> float:
    """-log of the battery's combined p-value: exponentially distributed for random strings.

    Fisher's sum, with Brown's correction: runs and serial correlation see the same neighbours
    (their normal scores correlate with 3 / 4), which adds 2 * SHARED to the variance of the sum.
    """
    total = -2 * sum(math.log(max(p, 1e-300)) for p in battery(string, alphabet))
    mean, variance = 6.0, 12.0 + 2 * SHARED
    stretch, freedom = variance / (2 * mean), 2 * mean * mean / variance
    scale = 2 / (9 * freedom)
    z = ((total / stretch / freedom) ** (1 / 3) - (1 - scale)) / math.sqrt(scale)
    p = upper_tail(z)
    return -math.log(p) if p > 0 else z * z / 2


def prose_bound(string: str, alphabet: str, log_prose: dict[str, float]) -> float:
    """-log of the bound on the chance of such a string in prose, corrected for the choice of encoding."""
    ratio = sum(-math.log(len(alphabet)) - log_prose[c] for c in string) - math.log(len(ENCODINGS))
    return max(0.0, ratio)


def length_class(n: int) -> int:
    """20-31: 0, 32-63: 1, 64-127: 2 and so on."""
    return max(0, n.bit_length() - 5)


def free_stretches(start: int, end: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What taken (sorted, may overlap) leaves of start..end."""
    out = []
    for a, b in taken:
        if b <= start or a >= end:
            continue
        if a > start:
            out.append((start, a))
        start = max(start, b)
    if start < end:
        out.append((start, end))
    return out


def candidates(text: str, taken: list[tuple[int, int, str]], log_prose: dict[str, float]) -> list[tuple[int, int, float, float]]:
    """(start, end, -log p of the battery, nats against prose) of each string outside taken, and of its parts between separators."""
    out, ranges = [], sorted((s, e) for s, e, _ in taken)
    for m in CANDIDATE.finditer(text):
        at = bisect.bisect_left(ranges, (m.end(),))
        near = [r for r in ranges[:at] if r[1] > m.start()]
        for a, b in free_stretches(m.start(), m.end(), near) if near else [m.span()]:
            pieces = {(a, b), *((a + p.start(), a + p.end()) for p in PART.finditer(text[a:b]))}
            for s, e in sorted(pieces):
                string = text[s:e].rstrip("=")
                if len(string) >= LEAST_LENGTH:
                    alphabet = ENCODINGS[encoding_of(string)]
                    out.append((s, e, not_random(string, alphabet), prose_bound(string, alphabet, log_prose)))
    return out


def prose_frequencies(docs: DataFrame) -> dict[str, float]:
    """log of each credential character's share of all such characters in all texts; at most 66 numbers."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in slices(batches, "text"):
            for text in texts_of(batch.column("text")):
                total += np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
        yield pa.record_batch([pa.array(CREDENTIAL_BYTES.astype(np.int32)), pa.array(total[CREDENTIAL_BYTES])], names=["code", "n"])

    rows = docs.select("text").mapInArrow(counted, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    n = {chr(r.code): r.n + 1 for r in rows} or dict.fromkeys(ENCODINGS["mixed"], 1)
    return {c: math.log(n[c] / sum(n.values())) for c in n}


def all_spans(docs: DataFrame, log_prose: dict[str, float]) -> DataFrame:
    """doc_id and, in order of start and kind, base spans and all candidates with their class, battery and nats.

    One pass over the texts. Those without a run of 20 credential characters or the
    beginning of an assignment are told apart by whole-column searches first.
    """
    order = {k: i for i, k in enumerate(KINDS)}
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("class", pa.int32()), ("battery", pa.float64()), ("nats", pa.float64())]))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            column = batch.column("text")
            named = pc.fill_null(pc.match_substring_regex(column, ASSIGN_START), False)
            run = pc.fill_null(pc.match_substring_regex(column, RUN), False)
            found = []
            for text, has_run, maybe in zip(texts_of(column), run.to_pylist(), pc.or_(named, run).to_pylist(), strict=True):
                spans = [(*span, None, None, None) for span in base_spans(text)] if maybe else []
                if has_run:
                    spans += [(s, e, "random", length_class(e - s), p, nats) for s, e, p, nats in candidates(text, [x[:3] for x in spans], log_prose)]
                spans.sort(key=lambda x: (x[0], order[x[2]]))
                found.append([dict(zip(("start", "end", "kind", "class", "battery", "nats"), x, strict=True)) for x in spans])
            yield pa.record_batch([batch.column("doc_id"), pa.array(found, kind)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scanned, "doc_id long, spans array<struct<start: int, end: int, kind: string, class: int, battery: double, nats: double>>")


def rejected_from(bins: list[tuple[int, int]], per_nat: int, rate: float) -> float | None:
    """Benjamini-Hochberg on (bin of -log p, number): the least -log p that is rejected, None if none is."""
    m, rank, out = sum(n for _, n in bins), 0, None
    for b, n in sorted(bins, reverse=True):
        rank += n
        if b and math.exp(-b / per_nat) <= rate * rank / m:
            out = b / per_nat
    return out


def discovery_thresholds(spans: DataFrame, rate: float = FALSE_DISCOVERY_RATE, lost: float = RANDOM_LOST) -> dict[int, tuple[float, float]]:
    """By length class: the -log p of the battery from which a string isn't random, and the nats
    against prose from which one of the others is a secret.

    Taken from a histogram of all candidates; its size doesn't grow with the corpus.
    """
    tested = spans.select(F.explode("spans").alias("s")).where(F.col("s.kind") == "random")
    binned = lambda c, top, per: F.floor(F.least(c, F.lit(float(top))) * per)
    rows = tested.groupBy(F.col("s.class").alias("class"), binned("s.battery", BATTERY_TOP, BATTERY_BINS_PER_NAT).alias("battery"), binned("s.nats", TOP_NATS, BINS_PER_NAT).alias("nats")).agg(F.count("*").alias("n")).collect()
    out = {}
    for size in {r["class"] for r in rows}:
        own = [r for r in rows if r["class"] == size]
        random_below = rejected_from([(r.battery, r.n) for r in own], BATTERY_BINS_PER_NAT, lost)
        random_below = math.inf if random_below is None else random_below
        least = rejected_from([(r.nats, r.n) for r in own if r.battery / BATTERY_BINS_PER_NAT < random_below], BINS_PER_NAT, rate)
        if least is not None:
            out[size] = random_below, least
    return out


def scan_secrets(docs: DataFrame, rate: float = FALSE_DISCOVERY_RATE, lost: float = RANDOM_LOST) -> DataFrame:
    """One row per document: doc_id, spans array<struct<start, end, kind>> in order of start, then kind.

    docs needs doc_id and text; other columns are ignored. Offsets are code points, end
    exclusive. Of a string and its parts the string itself is shown if it is a secret. Null and
    empty texts have no spans. Repeated rows and null doc_ids are scanned like any row. An empty
    table gives no rows.
    """
    spans = staged(all_spans(docs, prose_frequencies(docs)), "spans")
    found = discovery_thresholds(spans, rate, lost)
    # Two numbers per length class: at most 28 terms.
    terms = [f"(%s.class = {size} AND %s.battery < {'double(\'infinity\')' if math.isinf(p) else f'{p!r}D'} AND %s.nats >= {nats!r}D)" for size, (p, nats) in found.items()]
    secret = lambda x: "(" + " OR ".join([f"{x}.kind <> 'random'", *(t.replace("%s", x) for t in terms)]) + ")"
    inside = f"exists(spans, w -> w.kind = 'random' AND w.start <= s.start AND w.end >= s.end AND w.end - w.start > s.end - s.start AND {secret('w')})"
    chosen = f"{secret('s')} AND NOT (s.kind = 'random' AND {inside})"
    return spans.select("doc_id", F.expr(f"transform(filter(spans, s -> {chosen}), s -> struct(s.start AS start, s.end AS end, s.kind AS kind))").alias("spans"))


def digest_columns(scanned: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans (as a string) of scan_secrets."""
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return scanned.select("doc_id", *map(n, KINDS), F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))
