"""The training-data operators against brute force, on inputs with nulls, copies, ties and clashing columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from litfunnel.llm import chat, decontaminate, exact_dedup, fixity, lm_score, ngram_join, packing, secret_scan, token_counts, toxicity
from litfunnel.llm.common import tokenizer_path
from litfunnel.llm.components import connected_components
from litfunnel.llm.tokens import encoder_of

SCHEMA = "doc_id long, text string, lang string, score double, _key string, digest string"


def docs_of(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, None, 0.5, "x", "y") for i, t in zip(ids, texts)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    words = ["the", "of", "and", "re", *("w" + str(i) for i in range(400))]
    base = [" ".join(r.choices(words, k=r.randint(20, 120))) for _ in range(40)]
    out = list(base) + [base[0]] * 5 + [base[1].replace(" ", "  \n")] * 3
    for t in base[:15]:
        for _ in range(12):
            w = t.split()
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = r.choice(words)
            out.append(" ".join(w))
    return out + [None, "", "   ", "one", "one two three", "One Two three", "x " * 30_000]


def shingles(text, size=4):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if x]
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def components(texts, size=4, percent=85):
    sets, parent = [shingles(t, size) for t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if a and n and 100 * n >= percent * (len(a) + len(sets[j]) - n):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))], [len(s) for s in sets]


def test_ngram_join_finds_every_link(spark, texts, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP_TOKENS", 1 << 10)
    got = {r.doc_id: r for r in ngram_join.linked_documents(docs_of(spark, texts)).collect()}
    want, n = components(texts)
    assert [got[i].component_id for i in range(len(texts))] == want
    assert [got[i].n_shingles for i in range(len(texts))] == n


def test_ngram_join_group_large_in_one_partition_only(spark):
    r = random.Random(8)
    base = ["b" + str(i) for i in range(200)]

    def mutant(k, name):
        w = list(base)
        for i in r.sample(range(0, 200, 4), k):
            w[i] = f"{name}x{i}"
        return " ".join(w)

    # The leaders of the first partition link with nobody; its last member links with both of the second.
    texts = [mutant(7, f"m{i}") for i in range(200)] + [mutant(1, x) for x in "abc"]
    one, two = ([(i, t, None, 0.5, "x", "y") for i, t in enumerate(texts) if (i > 200) == second] for second in (False, True))
    c = spark.sparkContext
    d = spark.createDataFrame(c.parallelize(one, 1).union(c.parallelize(two, 1)), SCHEMA)
    want, _ = components(texts)
    assert want == [*range(201), 200, 200]
    got = {x.doc_id: x.component_id for x in ngram_join.linked_documents(d).collect()}
    assert [got[i] for i in range(len(texts))] == want


@pytest.mark.parametrize("n", [500, 2500])
def test_ngram_join_family_around_the_threshold(spark, monkeypatch, n):
    r = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for i in range(n):
        w = list(base)
        for j in r.sample(range(120), 1 + i % 2):
            w[j] = f"o{i}x{j}"
        texts.append(" ".join(w))
    number: dict[tuple, int] = {}
    rows = [[number.setdefault(x, len(number)) for x in shingles(t)] for t in texts]
    held = common_counts(rows, len(number))
    size = np.array([len(x) for x in rows])
    linked = 100 * held >= 85 * (size[:, None] + size[None, :] - held)
    want = np.arange(n)
    while True:
        newer = np.array([want[row].min() for row in linked])
        if (newer == want).all():
            break
        want = newer
    asked = []
    plain = ngram_join.opened_links
    monkeypatch.setattr(ngram_join, "GROUP_TOKENS", 1 << 14)
    monkeypatch.setattr(ngram_join, "opened_links", lambda a, *rest: asked.append(a.count()) or plain(a, *rest))
    got = {x.doc_id: x.component_id for x in ngram_join.linked_documents(docs_of(spark, texts)).collect()}
    assert [got[i] for i in range(n)] == want.tolist()
    # Whatever the family's size, a query asks a few groups, of thousands of other sets.
    assert sum(asked) <= 12 * n


def common_counts(rows, width):
    """How many shingles each two sets have in common, for shingles that more than one holds."""
    m = np.zeros((len(rows), width), np.float32)
    for i, x in enumerate(rows):
        m[i, x] = 1
    several = m[:, m.sum(0) > 1]
    both = several @ several.T
    np.fill_diagonal(both, m.sum(1))
    return both.astype(np.int64)


@pytest.mark.parametrize("shards", [512, (1 << 16) + 3])
def test_ngram_join_shards_have_no_limit(spark, texts, monkeypatch, shards):
    monkeypatch.setattr(ngram_join, "LEAST_SHARDS", shards)
    got = {x.doc_id: x.component_id for x in ngram_join.linked_documents(docs_of(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == components(texts)[0]


def test_linked_inside_by_definition():
    r = np.random.default_rng(3)
    for _ in range(60):
        m = int(r.integers(2, 25))
        core = np.arange(20)
        tokens = [np.unique(np.r_[r.permutation(core)[: r.integers(14, 21)], 100 + 30 * i + np.arange(r.integers(0, 3))]) for i in range(m)]
        extra = r.integers(0, 3, m)
        n = np.array([len(t) for t in tokens]) + extra
        starts = np.cumsum([0, *map(len, tokens)])[:-1]
        _, posts = np.unique(np.concatenate(tokens), return_inverse=True)
        want = list(range(m))
        for i in range(m):
            for j in range(i):
                if 185 * len(np.intersect1d(tokens[i], tokens[j])) >= 85 * (n[i] + n[j]):
                    a, b = sorted((want[i], want[j]))
                    want = [a if x == b else x for x in want]
        assert ngram_join.linked_inside(starts, posts, n, 85).tolist() == want


def test_one_of_each_keeps_columns(spark, texts):
    d = docs_of(spark, texts)
    kept = ngram_join.one_of_each(d)
    want, n = components(texts)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, c in enumerate(want) if c == i or not n[i]]


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (5, 5), (3, 1)], "u long, v long")
    assert {(r.node, r.component) for r in connected_components(e).collect()} == {(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)}


def test_exact_dedup(spark, texts):
    ids = [None, *range(1, len(texts) - 1), 1]
    rows = exact_dedup.exact_duplicates(docs_of(spark, [*texts[:-1], texts[1]], ids)).collect()
    plain = [(i, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()) for i, t in zip(ids, [*texts[:-1], texts[1]])]
    groups = collections.defaultdict(list)
    for i, h in plain:
        groups[h].append(i)
    least = {h: min((i for i in g if i is not None), default=None) for h, g in groups.items()}
    assert collections.Counter((r.doc_id, r.text_sha256, r.keep_id, r.group_size) for r in rows) == collections.Counter((i, h, least[h], len(groups[h])) for i, h in plain)
    kept = collections.Counter(r.text_sha256 for r in rows if r.kept)
    assert set(kept.values()) == {1} and set(kept) == set(groups)
    d = docs_of(spark, texts)
    assert exact_dedup.without_duplicates(d).columns == d.columns


def test_dedup_rejects_clashing_digests():
    e = np.zeros(2, exact_dedup.ENTRY)
    e["chars"] = 1, 2
    with pytest.raises(exact_dedup.DigestClash):
        exact_dedup.merged(e)


def test_packing_is_whole_and_tight(spark, texts):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(tokenizer_path())
    ids = {i: np.array([*tk.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in enumerate(texts)}
    pieces = packing.pack(docs_of(spark, texts).coalesce(1))
    rows, digests = pieces.collect(), {(r.doc_id, r.start): r.ids_crc32 for r in packing.with_digests(pieces).collect()}
    cover, used, tokens = collections.defaultdict(list), collections.defaultdict(list), collections.defaultdict(dict)
    for r in rows:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert len(piece) == r.length and piece.tobytes() == r.ids and r.doc_tokens == len(ids[r.doc_id]) and zlib.crc32(piece.tobytes()) == digests[r.doc_id, r.start]
        cover[r.doc_id].append((r.start, r.length))
        used[r.sequence_id].append((r.offset, r.length))
        tokens[r.sequence_id][r.offset] = piece
    for spans, total in [(sorted(cover[i]), len(ids[i])) for i in ids]:
        assert [s for s, _ in spans] == list(np.cumsum([0, *(n for _, n in spans)])[:-1]) and sum(n for _, n in spans) == total
    for spans in map(sorted, used.values()):
        assert [s for s, _ in spans] == list(np.cumsum([0, *(n for _, n in spans)])[:-1]) and sum(n for _, n in spans) <= 2048
    assert len(used) <= sum(map(len, ids.values())) / 2048 + 2
    whole = packing.sequences(pieces).collect()
    assert len(whole) == len(used)
    for s in whole:
        plain = np.concatenate([p for _, p in sorted(tokens[s.sequence_id].items())])
        length = len(plain) if bin(len(plain)).count("1") == 1 else 2048
        assert s.n_tokens == len(plain) and bytes(s.ids) == np.r_[plain, np.zeros(length - len(plain), "<u4")].astype("<u4").tobytes()
    # Many partitions: about a window of padding for each.
    many = packing.pack(docs_of(spark, texts).repartition(8)).select("sequence_id").distinct().count()
    assert many <= sum(map(len, ids.values())) / 2048 + 2 * 8


def test_encoder_agrees_with_tokenizers():
    r = random.Random(2)
    pool = [*"abzAZ019 \n\t'.,<|>éß×²\x1c\x85Σİ漢🙂", "'s", "<|endoftext|>"]
    e = encoder_of(tokenizer_path())
    for _ in range(2000):
        t = "".join(r.choices(pool, k=r.randint(0, 12)))
        assert list(e.ids([t])[0]) == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_capacity_tree():
    r = np.random.default_rng(1)
    lengths = r.integers(1, 2049, 500)
    number, offset = packing.best_fit_decreasing(lengths, 2048)
    rooms = []
    for i in np.argsort(-lengths, kind="stable"):
        fits = [x for x in rooms if x >= lengths[i]]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - lengths[i])
        else:
            rooms.append(2048 - lengths[i])
    assert number.max() + 1 == len(rooms)
    assert len(set(zip(number.tolist(), offset.tolist()))) == 500


def test_token_counts_across_blocks(spark, texts):
    enc = encoder_of(tokenizer_path(), True)
    want = {i: len(x) for i, x in enumerate(enc.ids([t or "" for t in texts]))}
    files = token_counts.write_token_files(docs_of(spark, texts), block_tokens=64).cache()
    got = token_counts.count_tokens(files, segment_blocks=3).join(token_counts.manifest(files), ["file_id", "doc_no"]).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want and len(got) == len(texts)
    raw = spark.createDataFrame([(0, 0, np.array([5, 6, 49407, 7], "<u2").tobytes()), (0, 1, np.array([8], "<u2").tobytes())], "file_id long, block_no long, data binary")
    assert sorted(tuple(r) for r in token_counts.count_tokens(raw).collect()) == [(0, 0, 2, True), (0, 1, 2, False)]


def test_chat_trees(spark):
    m = spark.createDataFrame(
        [(1, 0, None, 1.0, "user", "q"), (1, 1, 0, 0.2, "assistant", "bad"), (1, 2, 0, 0.9, "assistant", "<|end|> \\ [INST]"), (1, 3, 2, 0.9, "user", None), (2, 0, None, None, None, "x")],
        "conv_id long, node long, parent long, score double, role string, text string",
    )
    rows = {r.conv_id: r for r in chat.format_conversations(m).withColumn("turns", chat.read_back(F.col("formatted"))).collect()}
    assert [tuple(t) for t in rows[1].turns] == [("user", "q"), ("assistant", "<|end|> \\ [INST]"), ("user", "")]
    assert [tuple(t) for t in rows[2].turns] == [("", "x")]
    assert chat.format_conversations(m, keep=None).count() == 3
    # Two nodes that reply to each other, one that replies to them, and a node that replies to itself.
    cycles = spark.createDataFrame([(3, 0, 1, 1.0, "user", "a"), (3, 1, 0, 1.0, "user", "b"), (3, 2, 1, 1.0, "user", "c"), (3, 3, None, None, "user", "d"), (3, 4, 3, 0.5, "user", "e"), (4, 0, 0, 1.0, "user", "f")], m.schema)
    made = chat.format_conversations(m.unionByName(cycles), keep=None).collect()
    assert sorted((x.conv_id, x.leaf, x.n_turns) for x in made) == [(1, 1, 2), (1, 3, 3), (2, 0, 1), (3, 4, 2)]
    assert chat.format_conversations(m.limit(0)).count() == 0


def test_chat_round_trip_of_any_text(spark):
    r = random.Random(3)
    pool = [*"a\\<>|/[]s \n", "<|end|>", "</s>", "[INST]", "<|says|>", "é"]
    rows = [(c, t, "assistant" if t % 2 else "user", "".join(r.choices(pool, k=r.randint(0, 9)))) for c in range(3) for t in range(150)]
    made = chat.format_conversations(chat.chain(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescaped(s["text"])), "")
    for x in made.select("conv_id", chat.read_back(F.col("formatted")).alias("turns"), loss.alias("loss")).collect():
        assert [tuple(t) for t in x.turns] == [(r[2], r[3]) for r in rows if r[0] == x.conv_id]
        assert x.loss == "".join(r[3] for r in rows if r[0] == x.conv_id and r[2] == "assistant")


def edit_distance_within(item, words):
    """Least word edits of item against any stretch of words, by the plain table."""
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(words, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("kind", ["substitutions", "deletions", "insertions", "any"])
def test_decontamination_against_plain_edit_distance(spark, kind):
    """Recall with as many edits as allowed, against a scan of all documents by plain edit distance."""
    r = random.Random(kind)
    words = ["w" + str(i) for i in range(3000)]
    items = [(i, " ".join(r.choices(words, k=r.randint(5, 60) if i < 28 else 150))) for i in range(30)]
    planted, texts = set(), []
    for k in range(120):
        body, item = r.choices(words, k=r.randint(0, 120)), items[k % 30][1].split()
        w = list(item)
        for _ in range(int(0.2 * len(item)) if k % 4 else 0):
            at, what = r.randrange(len(w)), kind if kind != "any" else r.choice(["substitutions", "deletions", "insertions"])
            w[at : at + (what != "insertions")] = [] if what == "deletions" else ["other" + str(k)]
        at = r.randint(0, len(body))
        texts.append(" ".join(body[:at] + w + body[at:]))
        planted.add((k, k % 30))
    texts += [" ".join(r.choices(words, k=300))]
    want = {(d, i) for d, t in enumerate(texts) for i, item in items if (d, i) in planted or r.random() < 0.02 if edit_distance_within(item.split(), t.split()) <= int(0.2 * len(item.split()))}
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(x.doc_id, x.item_id): x for x in decontaminate.contaminated(docs_of(spark, texts), bench).collect()}
    assert want >= planted and set(found) <= planted and len(set(found) & want) >= 0.95 * len(want)
    for (d, i), x in found.items():
        item, t = items[i][1].split(), texts[d].split()
        assert x.edits == edit_distance_within(item, t) == edit_distance_within(item, t[x.first_word : x.end_word])


def test_decontamination_exact_way_and_special_items(spark):
    r = random.Random(9)
    words = ["w" + str(i) for i in range(500)]
    long = r.choices(words, k=1300)
    items = [(1, "alpha beta"), (2, "alpha beta gamma delta epsilon zeta"), (3, "alpha beta gamma delta epsilon zeta"), (4, None), (5, "  "), (3, "other words that are not there at all"), (6, " ".join(long))]
    changed = [w for i, w in enumerate(long) if i % 9]
    texts = ["x alpha, Beta y", "alpha gamma beta", "so alpha beta gamma delta epsilon eta end", " ".join(["pre"] * 50 + changed + ["post"] * 50), " ".join(long[:600]), None, "", "   "]
    d, bench = docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    want = {(0, 1), (2, 1), (2, 2), (2, 3), (3, 6)}
    for options in ({}, {"exact": True}, {"block_bytes": 4000}):
        assert {(x.doc_id, x.item_id) for x in decontaminate.contaminated(d, bench, **options).collect()} == want
    kept = decontaminate.without_contaminated(d, bench)
    assert kept.columns == d.columns and sorted(x.doc_id for x in kept.collect()) == [1, 4, 5, 6, 7]
    assert decontaminate.walks_for(20, 0.2, 0.9) <= decontaminate.walks_for(20, 0.2, 0.99)
    # More edits take more walks, without a silent end; where no number of them does, it is an error.
    assert decontaminate.walks_for(20, 0.2, 0.99) < decontaminate.walks_for(20, 0.3, 0.99)
    with pytest.raises(ValueError, match="exact"):
        decontaminate.walks_for(60, 0.9, 0.99)


def test_closest_stretch():
    n, a, b = decontaminate.closest_stretch(np.array([1, 2, 3, 4]), np.array([9, 1, 2, 7, 3, 4, 9]))
    assert (n, a, b) == (1, 1, 6)


def plain_record(url, html):
    body = (html or "").encode()
    return b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: " + (url or "").encode() + b"\r\nContent-Length: " + str(len(body)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def plain_root(rows, levels, range_bytes):
    """The root over one archive's rows (page_id, offset, bytes, digest, copies), by hashlib."""
    sha = lambda parts: hashlib.sha256(",".join(parts).encode()).hexdigest()
    nodes = collections.defaultdict(list)
    for page, offset, size, digest, copies in sorted(rows, key=lambda x: x[1]):
        nodes[offset // range_bytes].append((offset, offset + size, f"{offset}:{offset + size}:{'null' if page is None else page}:{digest}:{copies}"))
    level = {n: (x[0][0], max(e for _, e, _ in x), sha([t for *_, t in x])) for n, x in nodes.items()}
    for _ in range(levels):
        up = collections.defaultdict(list)
        for n in sorted(level):
            up[n // fixity.FAN_OUT].append((level[n][0], level[n][1], f"{n}:{level[n][0]}:{level[n][1]}:{level[n][2]}"))
        level = {n: (x[0][0], max(e for _, e, _ in x), sha([t for *_, t in x])) for n, x in up.items()}
    return level[0][2]


def test_fixity_trees_against_hashlib(spark):
    rows = [(i, f"http://x/{i}", "hé" * (i % 50)) for i in range(300)] + [(7, "http://x/7", "hé" * 7), (None, None, None), (None, "u", "")]
    store = fixity.store_of(spark.createDataFrame(rows, "page_id long, url string, html string"), archive_records=60)
    index = [tuple(r) for r in store.collect()]
    held = collections.Counter((p, hashlib.sha256(plain_record(u, h)).hexdigest(), len(plain_record(u, h))) for p, u, h in rows)
    assert {(p, sha, size): n for p, _, _, size, sha, n in index} == held
    by_archive = collections.defaultdict(list)
    for page, archive, offset, size, sha, n in index:
        by_archive[archive].append((page, offset, size, sha, n))
    for own in by_archive.values():
        own.sort(key=lambda x: x[1])
        assert [o for _, o, *_ in own] == list(np.cumsum([0, *(x[2] for x in own)])[:-1])
    levels = fixity.levels_of([store], 256)
    roots = {r.archive: r.hash for r in fixity.tree(store, levels, 256)[-1].collect()}
    assert levels == 2 and roots == {a: plain_root(own, levels, 256) for a, own in by_archive.items()}


def test_fixity_finds_every_kind_of_damage(spark):
    rows = [(i, f"http://x/{i}", "h" * i) for i in range(300)] + [(7, "http://x/7", "h" * 7), (None, None, None), (None, "u", "a")]
    store = fixity.store_of(spark.createDataFrame(rows, "page_id long, url string, html string"), archive_records=60)
    assert {r.status for r in fixity.audit(store, store).collect()} == {"ok"}
    sound = sorted((tuple(r) for r in store.collect()), key=lambda r: (r[1], r[2]))
    p, a, o, size, sha, n = range(6)
    changed, expected = [list(r) for r in sound], {}
    for at, status in ((3, "corrupt"), (9, "missing"), (20, "moved"), (30, "copies")):
        expected[tuple(sound[at][:3])] = status
    changed[3][sha] = "0" * 64
    changed[20][o] += 1
    changed[30][n] += 1
    # Two neighbours in reversed order: both begin elsewhere.
    x, y = changed[40], changed[41]
    assert x[a] == y[a] and sound[40][p] != sound[41][p]
    x[o], y[o] = sound[40][o] + y[size], sound[40][o]
    expected |= {tuple(sound[i][:3]): "moved" for i in (40, 41)}
    replica = [tuple(r) for i, r in enumerate(changed) if i != 9] + [(999, 0, 10**7, 10, "f" * 64, 1)]
    got = {(r.page_id, r.archive, r.offset): r.status for r in fixity.audit(store, spark.createDataFrame(replica, store.schema), range_bytes=512).collect()}
    assert got.pop((999, 0, 10**7)) == "extra"
    assert got == {tuple(r[:3]): expected.get(tuple(r[:3]), "ok") for r in sound}
    empty = store.limit(0)
    assert fixity.audit(empty, empty).count() == 0
    assert {r.status for r in fixity.audit(store, empty).collect()} == {"missing"} and {r.status for r in fixity.audit(empty, store).collect()} == {"extra"}


def plain_spans(text):
    """The base patterns by hand, character by character where the contract speaks of runs."""
    out, low = [], "".join(c.lower() if c.isascii() else c for c in text)

    def run(start, allowed):
        end = start
        while end < len(text) and text[end] in allowed:
            end += 1
        return end

    digits, lower = "0123456789", "abcdefghijklmnopqrstuvwxyz"
    upper = lower.upper()
    at = 0
    while at < len(text):
        word = next((w for w in ("password", "passwd", "secret", "token", "api_key", "apikey") if low.startswith(w, at)), None)
        end = None
        if word:
            i = at + len(word)
            i += text[i : i + 1] in ('"', "'") and i < len(text)
            i = run(i, " ")
            if i < len(text) and text[i] in ":=":
                i = run(i + 1, " ")
                quoted = i < len(text) and text[i] in "\"'"
                value = run(i + quoted, digits + lower + upper + "+/_.=-")
                end = value if value > i + quoted else None
                if end and end - i - quoted >= 8:
                    out.append((at, "assign", end))
        at = end or at + 1
    for kind, head, allowed, least in (("access", "AKIA", digits + upper, 16), ("hex", "", digits + "abcdef", 32)):
        at = 0
        while at < len(text):
            end = run(at + len(head), allowed) if text.startswith(head, at) else at
            if end - at > len(head) and end - at >= least:
                out.append((at, kind, end))
            at = max(end, at + 1)
    return sorted(out, key=lambda x: (x[0], ["assign", "access", "hex"].index(x[1])))


def test_base_spans_against_a_plain_scanner():
    r = random.Random(11)
    pool = ["password", "Passwd", "SECRET", "token", "api_key", "apikey", "api", ":", "=", " ", '"', "'", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "x", "é", "K", ".-_", "\n", "abcdefgh"]
    for _ in range(4000):
        t = "".join(r.choices(pool, k=r.randint(0, 14)))
        assert [(s, k, e) for s, e, k in sorted(secret_scan.base_spans(t), key=lambda x: (x[0], secret_scan.KINDS.index(x[2])))] == plain_spans(t), t


def test_battery_is_uniform_for_random_strings():
    r = np.random.default_rng(5)
    for name, n in (("decimal", 24), ("hex", 40), ("lower", 64), ("base62", 20), ("base64url", 128)):
        alphabet = list(secret_scan.ENCODINGS[name])
        strings = ["".join(r.choice(alphabet, n)) for _ in range(1200)]
        p = np.array([[*secret_scan.battery(s, alphabet), np.exp(-secret_scan.not_random(s, alphabet))] for s in strings])
        assert (abs((p < 0.05).mean(0) - 0.05) < 0.03).all() and (abs((p < 0.5).mean(0) - 0.5) < 0.11).all()
    for prose in ("theriverrunstotheseaandtheseareturnsittothetrees" * 3, "a" * 40, "ab" * 30, "0123456789" * 4):
        assert secret_scan.not_random(prose, secret_scan.ENCODINGS[secret_scan.encoding_of(prose)]) > 4.6


def test_secrets(spark):
    key = hashlib.sha256(b"1").hexdigest()[:40]
    prose = "this is plain prose and the quick brown fox jumps over a very lazy dog with long words "
    texts = [f'token = "{key}" x', "token=token:abcdefgh", "AKIAABCDEFGHIJKL AKIAB", None, "", prose * 200, "see q8Zr4TnW2xYpL0vKs7Jd3HfBm9Ec6Ga1 here", "thisisaverylongwordofplainprose", "a/path/to/users/q8Zr4TnW2xYpL0vKs7Jd3HfBm9Ec6Ga1"]
    rows = {r.doc_id: r for r in secret_scan.digest_columns(secret_scan.scan_secrets(docs_of(spark, texts))).collect()}
    assert (rows[0].n_assign, rows[0].n_hex) == (1, 1)
    assert rows[1].n_assign == 0 and rows[2].n_access == 1 and rows[3].spans == rows[4].spans == rows[5].spans == rows[7].spans == ""
    assert rows[6].n_random == 1 and rows[8].n_random == 1
    for i, t in enumerate(texts):
        shown = ",".join(f"{k}:{s}:{e}" for s, k, e in plain_spans(t or ""))
        assert rows[i].base_sha256 == hashlib.sha256(shown.encode()).hexdigest()


@pytest.mark.parametrize("encoding", ["hex_upper", "base32", "base36", "base62", "base64", "base64url", "decimal"])
def test_secret_recall(spark, encoding):
    """Planted random keys of each encoding and length among prose with long words."""
    r = random.Random(encoding)
    vocabulary = ["".join(r.choices("etaoinshrdlu", weights=[12, 9, 8, 8, 7, 7, 6, 6, 6, 4, 4, 3], k=r.randint(2, 9))) for _ in range(2000)]
    texts, planted = [], {}
    for i in range(300):
        w = r.choices(vocabulary, k=150)
        if i % 3 == 0:
            w[r.randrange(150)] = "".join(r.choices(vocabulary, k=6))
        if i % 5 == 0:
            w[75] = "".join(r.choices(secret_scan.ENCODINGS[encoding], k=(24, 32, 48)[i % 3]))
            planted[i] = w[75].rstrip("=")
        texts.append(" ".join(w))
    rows = secret_scan.scan_secrets(docs_of(spark, texts)).collect()
    found = {x.doc_id: {texts[x.doc_id][s.start : s.end] for s in x.spans} for x in rows}  # 32 digits or more are a base span
    hit = sum(any(p in f or f in p for f in found[i]) for i, p in planted.items())
    assert hit >= 0.9 * len(planted)
    assert sum(bool(f) for i, f in found.items() if i not in planted) <= 3


def test_maximal_segments_against_brute_force():
    r = np.random.default_rng(3)

    def plain(s, offset=0):
        best = max(((s[i:j].sum(), i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), key=lambda x: (round(x[0], 9), -(x[2] - x[1])), default=None)
        if best is None or best[0] <= 0:
            return []
        _, i, j = best
        return plain(s[:i], offset) + [(offset + i, offset + j)] + plain(s[j:], offset + j)

    for _ in range(60):
        s = r.normal(-0.2, 1, r.integers(0, 14))
        assert [(a, b) for a, b, _ in toxicity.maximal_segments(s)] == plain(s)


def test_toxicity_held_out(spark):
    r = random.Random(6)
    words, bad = ["w" + str(i) for i in range(300)], ["vile", "nasty", "rotten"]
    texts, labels = [], []
    for i in range(900):
        w, toxic = r.choices(words, k=80), int(i % 6 == 0)
        for _ in range(3 * toxic):
            w[r.randrange(80)] = r.choice(bad)
        texts.append(" ".join(w))
        labels.append((i, 1, toxic))
    d = docs_of(spark, [*texts, None, ""])
    model = toxicity.fit(d, spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int"))
    scored = toxicity.score_toxicity(d, model)
    assert set(scored.columns) == set(d.columns)
    held = [x for x in scored.collect() if x.doc_id < 900 and zlib.crc32(str(x.doc_id).encode()) % 3 == 1]
    assert sum((x.score >= 0.7) == (labels[x.doc_id][2] == 1) for x in held) >= 0.97 * len(held)
    assert all(0 <= x.score <= 1 for x in scored.collect())
    assert toxicity.toxic_passages(d, model).count() > 0


def test_toxicity_scores_more_words_than_the_cache_holds(monkeypatch):
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 5)
    r = np.random.default_rng(2)
    model = toxicity.Model(r.normal(size=toxicity.BUCKETS), np.full(toxicity.BUCKETS, 0.1))
    cache = {}
    for text in ("a b c", "a d e f g h a", "h a"):
        assert model.scores(text, cache).tolist() == [model.word_score(w) for w in text.split()]
        assert len(cache) <= 5


def test_toxicity_fit_uses_all_segments_and_documents(spark):
    r = random.Random(7)
    words, texts = ["w" + str(i) for i in range(300)], []
    for i in range(240):
        w = r.choices(words, k=r.choice((60, 2000)))
        for j in range(0, len(w), 15) if r.random() < (0.8 if i % 3 == 0 else 0.1) else ():
            w[j] = "vile"
        texts.append(" ".join(w))
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(240)], "doc_id long, quality int, toxic int")
    d = docs_of(spark, texts)
    model = toxicity.fit(d, labels)
    tuning = [i for i in range(240) if (c := zlib.crc32(str(i).encode())) % 3 != 1 and c // 3 % 4 == 0]
    assert max(len(toxicity.maximal_segments(model.scores(texts[i], {}))) for i in tuning) > 50
    evidence = np.array([model.evidence(texts[i], {}) for i in tuning])
    missed = np.array([i % 3 == 0 for i in tuning]) - model.probability(evidence)
    assert model.slope > 0.01 and missed @ np.log1p(evidence) == pytest.approx(0.05 * model.slope, abs=1e-4)
    more = toxicity.fit(docs_of(spark, [*texts, *["vile"] * 500]), labels)
    assert abs(more.delta - model.delta).max() > 0


@pytest.mark.parametrize(("head", "frequent"), [(1 << 16, 1024), (30, 4), (2, 1)])
def test_lm_score_against_counts(spark, texts, monkeypatch, head, frequent):
    """The scores don't depend on which words and pairs are shipped beforehand."""
    import math

    monkeypatch.setattr(lm_score, "FREQUENT", frequent)
    monkeypatch.setattr(lm_score, "BATCH_BYTES", 2000)
    monkeypatch.setattr(lm_score, "LEAST_SHARDS", 7)
    own = [*[t for t in texts if t and len(t) < 5000][:80], "only here and only once", "one"]
    d = docs_of(spark, [*own, None]).withColumn("target", F.when(F.col("doc_id") != 40, F.col("doc_id") < 30))
    got = {x.doc_id: x for x in lm_score.cross_entropy_difference(d, head=head).collect()}
    toks = [t.lower().split() for t in own]
    uni = [collections.Counter(w for t in toks[:n] for w in t) for n in (len(own), 30)]
    bi = [collections.Counter(p for t in toks[:n] for p in zip(t, t[1:])) for n in (len(own), 30)]
    size, total = len(uni[0]) + 1, [sum(u.values()) for u in uni]
    share = lambda k, w: (uni[k][w] + 1 / size) / (total[k] + 1)

    def diff(a, b):
        n = [bi[0][a, b], bi[1][a, b]] if bi[0][a, b] > 1 else [0, 0]
        p = [(n[k] + 50 * share(k, b)) / (uni[k][a] + 50) for k in (0, 1)]
        return math.log(p[0]) - math.log(p[1])

    for i, t in enumerate(toks):
        want = (math.log(share(0, t[0])) - math.log(share(1, t[0])) + sum(diff(a, b) for a, b in zip(t, t[1:]))) / len(t)
        assert got[i].n_tokens == len(t) and got[i].score == pytest.approx(want, abs=1e-4)
    assert got[len(own)].n_tokens == 0 and got[len(own)].score == 0


def test_lm_score_marks_labelled_documents(spark):
    d = docs_of(spark, ["a", "b", "c"], [1, None, 3])
    labels = spark.createDataFrame([(1, 1), (1, 1), (3, 0), (None, 1)], "doc_id long, quality int")
    assert sorted((r.doc_id or 0, r.target) for r in lm_score.with_target(d, labels).collect()) == [(0, False), (1, True), (3, False)]
    with pytest.raises(ValueError):
        lm_score.fitted_words(d, head=1 << 17)


def test_empty_tables(spark):
    d = docs_of(spark, ["x"]).limit(0)
    bench = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert packing.pack(d).count() == exact_dedup.exact_duplicates(d).count() == ngram_join.linked_documents(d).count() == 0
    assert decontaminate.contaminated(d, bench).count() == secret_scan.scan_secrets(d).count() == lm_score.cross_entropy_difference(d.withColumn("target", F.lit(True))).count() == 0
    assert decontaminate.contaminated(docs_of(spark, ["x y z"]), bench.limit(0)).count() == 0
    files = token_counts.write_token_files(d)
    assert files.count() == token_counts.count_tokens(files).count() == token_counts.manifest(files).count() == 0
    none = spark.createDataFrame([(0, 0, None), (0, 1, b"")], "file_id long, block_no long, data binary")
    assert token_counts.count_tokens(none).count() == 0
    model = toxicity.fit(d, spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int"))
    assert toxicity.score_toxicity(d, model).count() == 0
    assert chat.format_conversations(chat.chain(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def vile_model():
    model = toxicity.Model(np.full(toxicity.BUCKETS, -0.4), np.full(toxicity.BUCKETS, 0.1), rate=1.0, scale=0.01)
    model.delta[toxicity.features("vile")] = 5.0
    return model


def segments_by_definition(scores):
    """The best stretch (of equal ones the leftmost shortest), then the same on either side of it."""
    best = max(((sum(scores[a:b]), -(b - a), -a) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 1e-9:
        return []
    a = -best[2]
    b = a - best[1]
    right = [(x + b, y + b, s) for x, y, s in segments_by_definition(scores[b:])]
    return segments_by_definition(scores[:a]) + [(a, b, best[0])] + right


def test_passages_against_definition(spark):
    r = random.Random(8)
    model = vile_model()
    texts = ["İstanbul İzmir calm words here vile vile calm end of text", None, "", " . "]
    for _ in range(60):
        words = r.choices(["İzmir", "calm", "vile", "VILE", "Straße", "ΑΣ", "a"], weights=[2, 4, 3, 1, 1, 1, 2], k=r.randrange(1, 25))
        texts.append("".join(w + r.choice([" ", ", ", "\n", "İ "]) for w in words))
    docs = spark.createDataFrame([(i if i % 7 else None, t, "x", 1) for i, t in enumerate(texts)] + [(1, texts[0], "x", 1)] * 2, "doc_id long, text string, passage string, start int").repartition(4)
    want = collections.Counter()
    for doc_id, t in [(r.doc_id, r.text or "") for r in docs.collect()]:
        owner = [i for i, c in enumerate(t) for _ in c.lower()]
        spans = [m.span() for m in re.finditer(r"\w+", t.lower())]
        scores = [model.word_score(t.lower()[a:b]) for a, b in spans]
        for a, b, s in segments_by_definition(scores):
            e = model.rate * s - np.log(max(model.scale * len(scores), 1e-9))
            if e > -np.log(0.01):
                first, last = owner[spans[a][0]], owner[spans[b - 1][1] - 1] + 1
                want[doc_id, first, last, round(e, 6), t[first:last]] += 1
    got = collections.Counter((x.doc_id, x.start, x.end, round(x.significance, 6), x.passage) for x in toxicity.toxic_passages(docs, model).collect())
    assert got == want and any(p == "vile vile" for *_, p in got)
