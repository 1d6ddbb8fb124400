"""Exact self-join of documents on the Jaccard similarity of their word n-gram sets, by a token-group matrix.

Distinct shingle sets are first bounded against the union of all others: the matrix is dealt by
token, so that each shard tells which tokens of a set some other set holds too. Sets below the
threshold of their own size can't be linked and drop out, most of a corpus at once. The others
keep their shared tokens, ordered from tokens of few sets to tokens of many.

These are partitioned into groups of similar sets, by the least hash of their tokens; a large
group is cut by digest into parts of at most some GROUP_TOKENS. One row of the matrix holds a group: the
union of its tokens, the places of each member's tokens in it, and what is linked inside, where
every pair is decided unless links already join it.

A query is a set that shares one of its first tokens with a set of another group, so near in size and
place that a link is possible; a partner must share one of those. Each query counts its tokens in the
stored union and opens the group only if that bound reaches the threshold; an open group's members are
decided exactly, all at once. First each query asks the group of the set that has least to itself under
its tokens, which joins families around their original; then it asks all groups that aren't known to be
of its component. Nothing is sampled or capped, and no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litfunnel.llm.common import arrow_rows, discard, hidden, slices, staged, texts_of, without_rows
from litfunnel.llm.components import connected_components

SIZE = 4
PERCENT = 85
#: A group is cut into parts of some so many tokens; a set counts as LEAST_TOKENS at least, so that a part has few sets too.
GROUP_TOKENS, LEAST_TOKENS = 1 << 17, 1 << 9
#: A group row is sent once for so many queries.
GROUP_QUERIES = 512
#: A token has 32 bits and its shard; with 512 shards two different shingles of a pair agree by chance with 5e-13.
SHARD_BYTES, LEAST_SHARDS = 6 << 20, 512
FLUSH_TOKENS, FLUSH_SETS = 500_000, (1 << 16) - 1
#: A token of more sets of one flush is dealt once, with their number.
HOT_TOKEN = 64
MARK = (1 << 16) - 1
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x = x ^ (x >> np.uint64(33))
    x = x * _M2
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: pa.Array, size: int = SIZE) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes.

    A-Z are lower-cased, words are stretches without [\\x20\\x09-\\x0D]. A text of fewer than
    size words has its whole sequence as one shingle; one without words, or null, has none.
    """
    texts = pa.array(texts_of(texts), pa.large_string())  # a fresh array: Arrow's splitter misreads slices
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = parts.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) if w else 0 for w in words), np.uint64, len(words))
    flat, bounds = hashes[coded.indices.to_numpy()] if len(words) else np.empty(0, np.uint64), parts.offsets.to_numpy()
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        w = flat[a:b]
        w = w[w != 0]
        n = len(w)
        if not n:
            out.append(w)
            continue
        k = min(size, n)
        h = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            h = mixed(h * _STEP + w[i : n - k + 1 + i] + np.uint64(k))
        out.append(np.unique(h))
    return out


#: What travels: kind 0 documents, 1 tokens of one shard, 2 sets of a flush, 3 owners of a flush's hot tokens.
SENT = pa.schema([
    ("kind", pa.int32()), ("shard", pa.int32()), ("flush", pa.int64()), ("tokens", pa.binary()), ("owners", pa.binary()), ("weights", pa.binary()),
    ("doc_ids", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("digests", pa.list_(pa.string())),
])
SENT_SQL = "kind int, shard int, flush long, tokens binary, owners binary, weights binary, doc_ids array<long>, keys array<long>, sizes array<int>, digests array<string>"
MEMBERS = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("digest", pa.string()), ("n", pa.int32()), ("shared", pa.int32()), ("least", pa.int64()), ("tokens", pa.binary()), ("prefix", pa.list_(pa.int64()))])
MEMBERS_SQL = "kind int, doc_id long, text_key long, digest string, n int, shared int, least long, tokens binary, prefix array<long>"


def filled(schema: pa.Schema, **columns: object) -> pa.RecordBatch:
    """A batch of the schema; columns that aren't given are null."""
    n = len(next(iter(columns.values())))
    given = lambda f: columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
    return pa.RecordBatch.from_arrays([given(f) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def runs_of(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])


def dealt_tokens(docs: DataFrame, shards: int, size: int) -> DataFrame:
    """The matrix by rows: documents, and the tokens of each distinct set of a partition by shard."""
    most = min(max(FLUSH_TOKENS, shards * 1000), 4 * FLUSH_TOKENS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        flush = TaskContext.get().partitionId() << 24
        known: set[bytes] = set()
        keys, sizes, digests, held = [], [], [], 0

        def dealt() -> Iterator[pa.RecordBatch]:
            owner = np.repeat(np.arange(len(keys), dtype=np.uint64), [len(x) for x in keys])
            key = np.concatenate(keys)
            if shards <= 1 << 16:
                # Shard, token and owner in one number: one sort puts all in order.
                packed = np.sort((key << np.uint64(16)) | owner)
                key, owner = packed >> np.uint64(16), (packed & np.uint64(MARK)).astype("<u2")
            else:
                order = np.argsort(key, kind="stable")
                key, owner = key[order], owner[order].astype("<u2")
            start = runs_of(key)
            count = np.diff(np.r_[start, len(key)])
            hot = count > HOT_TOKEN
            home = [flush % shards]
            yield filled(SENT, kind=[2], shard=home, flush=[flush], sizes=[sizes], digests=[digests])
            weight = np.ones(len(key), "<u4")
            if hot.any():
                inside = np.repeat(hot, count)
                yield filled(SENT, kind=[3], shard=home, flush=[flush], tokens=[key[inside].tobytes()], owners=[owner[inside].tobytes()])
                weight[start], owner[start[hot]] = np.where(hot, count, 1), MARK
                stay = ~inside
                stay[start] = True
                key, owner, weight = key[stay], owner[stay], weight[stay]
            edges = np.append(runs_of(key >> np.uint64(32)), len(key))
            full = (key[edges[:-1]] >> np.uint64(32)).astype(np.int64).tolist()
            token = key.astype("<u4")
            for i in range(0, len(full), 256):
                cuts = [slice(*edges[k : k + 2]) for k in range(i, min(i + 256, len(full)))]
                marked = [owner[c] == MARK for c in cuts]
                yield filled(
                    SENT, kind=[1] * len(cuts), shard=full[i : i + 256], flush=[flush] * len(cuts), tokens=[token[c].tobytes() for c in cuts],
                    owners=[owner[c].tobytes() for c in cuts], weights=[weight[c][m].tobytes() for c, m in zip(cuts, marked, strict=True)],
                )

        for batch in slices(batches, "text", 4 << 20):
            own_sizes, own_digests = [], []
            for shingles in shingle_sets(batch.column("text"), size):
                digest = xxhash.xxh3_128_digest(shingles.tobytes())
                own_sizes.append(len(shingles))
                own_digests.append(digest.hex())
                if len(shingles) and digest not in known:
                    known.add(digest)
                    key = np.unique(((shingles >> np.uint64(32)) % np.uint64(shards) << np.uint64(32)) | (shingles & np.uint64(0xFFFFFFFF)))
                    keys.append(key)
                    sizes.append(len(shingles))
                    digests.append(digest.hex())
                    held += len(key)
                    if held > most or len(keys) == FLUSH_SETS:
                        yield from dealt()
                        flush += 1
                        keys, sizes, digests, held = [], [], [], 0
            as_list = lambda c, kind: pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(c).cast(kind))  # noqa: E731, B023
            yield filled(SENT, kind=[0], shard=[flush % shards], flush=[flush], doc_ids=as_list("doc_id", pa.int64()), keys=as_list("text_key", pa.int64()), sizes=[own_sizes], digests=[own_digests])
        if held:
            yield from dealt()

    return docs.mapInArrow(rows, SENT_SQL)


def joined_bytes(column: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of binaries, and how many each row has."""
    parts = [np.frombuffer(x or b"", kind) for x in column.to_pylist()]
    return np.concatenate(parts) if parts else np.empty(0, kind), np.array([len(x) for x in parts], np.int64)


def shared_tokens(table: pa.Table) -> pa.Table:
    """One shard: of each row the tokens that another set holds too, with a class of their number of sets."""
    own = pc.equal(table["kind"], 1)
    rest, table = table.filter(pc.invert(own)), table.filter(own)
    if not table.num_rows:
        return rest
    token, size = joined_bytes(table["tokens"], "<u4")
    owner, _ = joined_bytes(table["owners"], "<u2")
    weight = np.ones(len(token), np.int64)
    weight[owner == MARK] = joined_bytes(table["weights"], "<u4")[0]
    order = np.argsort(token, kind="stable")
    start = runs_of(token[order])
    sets = np.add.reduceat(weight[order], start)
    number = np.empty(len(token), np.int64)
    number[order] = np.repeat(sets, np.diff(np.r_[start, len(token)]))
    kept = number > 1
    group = np.minimum(np.log2(number) * 5, 255).astype(np.uint8)
    edges = np.r_[0, np.cumsum(size)]
    rows = [(i, slice(a, b)) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if kept[a:b].any()]
    pick = pa.array([i for i, _ in rows], pa.int64())
    out = filled(
        SENT, kind=table["kind"].combine_chunks().take(pick), shard=table["shard"].combine_chunks().take(pick), flush=table["flush"].combine_chunks().take(pick),
        tokens=[token[c][kept[c]].tobytes() for _, c in rows], owners=[owner[c][kept[c]].tobytes() for _, c in rows], weights=[group[c][kept[c]].tobytes() for _, c in rows],
    )
    return pa.concat_tables([rest, pa.Table.from_batches([out])])


def surviving_sets(table: pa.Table, percent: int) -> pa.Table:
    """One flush: its documents, and of its sets those that could reach the threshold with what all
    other sets hold: the tokens they share, from tokens of few sets to tokens of many."""
    kind = table["kind"].to_numpy()
    out = []
    for row in table.filter(pa.array(kind == 0)).to_batches():
        n = len(row.column("doc_ids").flatten())
        out.append(filled(MEMBERS, kind=[0] * n, doc_id=row.column("doc_ids").flatten(), text_key=row.column("keys").flatten(), digest=row.column("digests").flatten(), n=row.column("sizes").flatten()))
    sets = table.filter(pa.array(kind == 2))
    if sets.num_rows:
        sizes, digests = np.array(sets["sizes"][0].as_py(), np.int64), sets["digests"][0].as_py()
        sent = table.filter(pa.array(kind == 1))
        token, count = joined_bytes(sent["tokens"], "<u4")
        key = (np.repeat(sent["shard"].to_numpy().astype(np.uint64), count) << np.uint64(32)) | token
        owner, group = joined_bytes(sent["owners"], "<u2")[0].astype(np.int64), joined_bytes(sent["weights"], np.uint8)[0]
        hot = table.filter(pa.array(kind == 3))
        if hot.num_rows:
            marks = np.flatnonzero(owner == MARK)
            marks = marks[np.argsort(key[marks])]
            hot_key, hot_owner = np.frombuffer(hot["tokens"][0].as_py(), np.uint64), np.frombuffer(hot["owners"][0].as_py(), "<u2")
            hot_group = group[marks][np.searchsorted(key[marks], hot_key)]
            single = owner != MARK
            key, owner, group = np.r_[key[single], hot_key], np.r_[owner[single], hot_owner], np.r_[group[single], hot_group]
        shared = np.bincount(owner, minlength=len(sizes))
        enough = 100 * shared >= percent * sizes
        stay = enough[owner]
        key, owner, group = key[stay], owner[stay], group[stay]
        order = np.lexsort((key, group, owner))
        key, owner = key[order], owner[order]
        edges = np.searchsorted(owner, np.arange(len(sizes) + 1))
        own = np.flatnonzero(enough).tolist()
        cut = [key[edges[i] : edges[i + 1]] for i in own]
        # A partner holds at least percent of the set, so one of this many first tokens.
        first = sizes - -(-percent * sizes // 100) + 1
        prefix = [x[: max(0, int(first[i] - (sizes[i] - shared[i])))].astype(np.int64) for i, x in zip(own, cut, strict=True)]
        for a in range(0, len(own), 2000):
            part = slice(a, a + 2000)
            out.append(filled(MEMBERS, kind=[1] * len(own[part]), digest=[digests[i] for i in own[part]], n=sizes[own[part]], shared=shared[own[part]], least=[int(mixed(x).min().astype(np.int64)) for x in cut[part]], tokens=[x.tobytes() for x in cut[part]], prefix=prefix[part]))
    return pa.Table.from_batches(out, MEMBERS)


def members_of(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """kind 0: documents (doc_id, text_key, digest, n); kind 1: sets that may be linked (digest, n, shared, least, tokens, prefix)."""
    volume = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    # About one token of 6 bytes for 6 characters.
    shards = max(LEAST_SHARDS, int(volume) // SHARD_BYTES)
    with arrow_rows(docs.sparkSession, 1000):
        sent = dealt_tokens(docs, shards, size).groupBy("shard").applyInArrow(shared_tokens, SENT_SQL)
        return staged(sent.groupBy("flush").applyInArrow(lambda t: surviving_sets(t, percent), MEMBERS_SQL), "members")


def reach(x: np.ndarray, y: np.ndarray, both: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of x and y tokens, both of them common, reach the threshold."""
    return (100 + percent) * both >= percent * (x + y)


def linked_inside(starts: np.ndarray, posts: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """The component of each member of a group, as the number of its first member. starts and posts:
    where each member's tokens begin, and their places in the union.

    Members with least to themselves come first. The greatest component asks nobody while it is
    that: whatever is apart from it asks for both sides.
    """
    m, comp = len(n), np.arange(len(n))
    held = np.diff(np.r_[starts, len(posts)])
    todo, mark = np.argsort(n - held, kind="stable"), np.zeros(int(posts.max()) + 1, bool)
    while len(todo):
        size = np.bincount(comp, minlength=m)
        if size.max() > 1:
            todo = todo[comp[todo] != size.argmax()]
            if not len(todo):
                break
        i, todo = todo[0], todo[1:]
        own = posts[starts[i] : starts[i] + held[i]]
        mark[own] = True
        hit = reach(n[i], n, np.add.reduceat(mark[posts], starts, dtype=np.int64), percent)
        # Tokens that no other set holds aren't in the group: a set can fail to reach itself.
        hit[i] = True
        joined = np.unique(comp[hit])
        mark[own] = False
        if len(joined) > 1:
            comp[np.isin(comp, joined)] = joined[0]
    return comp


GROUPS = pa.schema([("g", pa.int64()), ("members", pa.list_(pa.string())), ("sizes", pa.list_(pa.int32())), ("first", pa.list_(pa.int32())), ("starts", pa.binary()), ("posts", pa.binary()), ("union", pa.binary())])
GROUPS_SQL = "g long, members array<string>, sizes array<int>, first array<int>, starts binary, posts binary, union binary"


def group_rows(sets: DataFrame, percent: int) -> DataFrame:
    """The token-group matrix: one row per group, with its members (digest order), the number of the first
    member of each one's component, and the union of their tokens. sets: g, digest, n, tokens."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, int, bytes]] = []
        made: list[tuple] = []
        volume, at = 0, None

        def row() -> tuple:
            tokens = [np.frombuffer(t, np.uint64) for _, _, t in held]
            starts = np.cumsum([0, *map(len, tokens)])[:-1]
            union, posts = np.unique(np.concatenate(tokens), return_inverse=True)
            n = np.array([x for _, x, _ in held], np.int64)
            first = linked_inside(starts, posts, n, percent) if len(held) > 1 else np.zeros(1, np.int64)
            return at, [d for d, _, _ in held], n.tolist(), first.tolist(), starts.astype("<u4").tobytes(), posts.astype("<u4").tobytes(), union.tobytes()

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), GROUPS, strict=True)], schema=GROUPS)

        for part in slices(batches, "tokens"):
            for g, *one in zip(*(part.column(c).to_pylist() for c in ("g", "digest", "n", "tokens")), strict=True):
                if held and g != at:
                    made.append(row())
                    volume += len(made[-1][-1]) + len(made[-1][-2])
                    held = []
                    if volume > 4 << 20 or len(made) == 1000:
                        yield batch()
                        made, volume = [], 0
                at = g
                held.append(tuple(one))
        if held:
            made.append(row())
        if made:
            yield batch()

    return sets.select("g", "digest", "n", "tokens").repartition("g").sortWithinPartitions("g", "digest").mapInArrow(rows, GROUPS_SQL)


def in_groups(sets: DataFrame) -> DataFrame:
    """sets with g, the group of similar sets: those of one least hash, cut by digest where they are many."""
    weight = F.greatest(F.octet_length("tokens") / 8, F.lit(LEAST_TOKENS))
    large = sets.groupBy("least").agg(F.ceil(F.sum(weight) / GROUP_TOKENS).alias("parts")).where("parts > 1")
    part = F.pmod(F.xxhash64("digest"), F.coalesce("parts", F.lit(1)))
    return sets.join(large, "least", "left").withColumn("g", F.xxhash64("least", part)).drop("parts", "least")


def member_links(groups: DataFrame) -> DataFrame:
    """(u, v): each member linked inside its group, with the first member of its component."""
    pairs = groups.select("members", F.posexplode("first").alias("i", "j")).where("i <> j")
    return pairs.select(F.element_at("members", F.col("i") + 1).alias("u"), F.element_at("members", F.col("j") + 1).alias("v"))


def query_places(sets: DataFrame) -> DataFrame:
    """(h, digest, g, n, shared, own, place): each first token of each query, its place and how many tokens are the query's own."""
    own = F.col("n") - F.col("shared")
    return sets.select("digest", "g", "n", "shared", own.alias("own"), F.posexplode("prefix").alias("i", "h")).withColumn("place", F.col("own") + F.col("i") + 1).drop("i")


def held_by_groups(places: DataFrame) -> DataFrame:
    """(h, to, low, high, most_after, most_shared): the groups whose sets have the first token h, with the least and
    greatest of these sets and how much they can have in common with others from there."""
    return places.groupBy("h", F.col("g").alias("to")).agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n") - F.col("place")).alias("most_after"), F.max("shared").alias("most_shared")
    )


def may_link(percent: int) -> Column:
    """Whether a query and some set of a group that first meet at a token can be linked, by their sizes,
    what they share with any set and their tokens behind that place."""
    n = F.col("n")
    partner = F.greatest("low", F.ceil(n * percent / 100))
    both = F.least(1 + F.least(n - F.col("place"), "most_after"), "shared", "most_shared")
    return (100 * F.col("high") >= percent * n) & (100 * n >= percent * F.col("low")) & ((100 + percent) * both >= percent * (n + partner))


def opened_links(asked: DataFrame, sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """A table of links (u, v) between queries and members of the groups they ask: one to each component that is
    joined inside such a group. asked: distinct (digest, to).

    A group's row meets its queries in one task, once for each GROUP_QUERIES of them.
    """
    copies = asked.groupBy(F.col("to").alias("g")).agg(F.ceil(F.count("*") / GROUP_QUERIES).cast("int").alias("copies"))
    salted = groups.join(copies, "g").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    rows = salted.select("g", "salt", F.lit("").alias("digest"), F.lit(0).alias("n"), F.lit(None).cast("binary").alias("tokens"), "members", "sizes", "first", "starts", "posts", "union")
    queries = asked.join(sets.select("digest", "n", "tokens"), "digest").withColumnRenamed("to", "g").join(copies, "g")
    salt = F.pmod(F.xxhash64("digest"), "copies").cast("int")
    queries = queries.select("g", salt.alias("salt"), "digest", "n", "tokens", *(F.lit(None).cast(groups.schema[c].dataType).alias(c) for c in ("members", "sizes", "first", "starts", "posts", "union")))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        union = posts = starts = sizes = first = np.empty(0, np.int64)
        members: list[str] = []
        for batch in slices(slices(batches, "union"), "tokens"):
            u, v = [], []
            whole = batch.column("union")
            for i, (digest, n, tokens) in enumerate(zip(batch.column("digest").to_pylist(), batch.column("n").to_pylist(), batch.column("tokens").to_pylist(), strict=True)):
                if tokens is None:
                    union, posts, starts = (np.frombuffer(batch.column(c)[i].as_py(), k) for c, k in (("union", np.uint64), ("posts", "<u4"), ("starts", "<u4")))
                    members, sizes, first = batch.column("members")[i].as_py(), np.array(batch.column("sizes")[i].as_py(), np.int64), np.array(batch.column("first")[i].as_py(), np.int64)
                    starts = starts.astype(np.int64)
                    continue
                own = np.frombuffer(tokens, np.uint64)
                at = np.minimum(np.searchsorted(union, own), len(union) - 1)
                at = at[union[at] == own]
                # The union holds at least what any member has in common with the query.
                if 100 * len(at) < percent * n or not reach(n, sizes.min(), len(at), percent):
                    continue
                mark = np.zeros(len(union), bool)
                mark[at] = True
                hit = np.flatnonzero(reach(n, sizes, np.add.reduceat(mark[posts], starts, dtype=np.int64), percent))
                if len(hit):
                    _, one = np.unique(first[hit], return_index=True)
                    u += [digest] * len(one)
                    v += [members[k] for k in hit[one]]
            yield pa.record_batch([pa.array(u, pa.string()), pa.array(v, pa.string())], names=["u", "v"])
            del whole

    with arrow_rows(sets.sparkSession, 500):
        # The group's row comes before its queries, as the empty digest does.
        return staged(rows.unionByName(queries).repartition("g", "salt").sortWithinPartitions("g", "salt", "digest").mapInArrow(links, "u string, v string"), "links")


def with_component(sets: DataFrame, parts: DataFrame) -> DataFrame:
    """sets (with digest) and the component each is known to be of, itself where it has no link."""
    return sets.join(parts.withColumnRenamed("node", "digest"), "digest", "left").withColumn("component", F.coalesce("component", "digest"))


def first_groups(places: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """(digest, to): each query and, under each of its first tokens, the group of the set that has least to itself,
    where that set is in another group and not known to be of one component with the query."""
    known = with_component(places, parts)
    heads = known.groupBy("h").agg(F.min(F.struct("own", "digest", "g", "component")).alias("head"), F.count("*").alias("k")).where("k > 1")
    heads = heads.select("h", F.col("head.g").alias("to"), F.col("head.component").alias("its"))
    return known.join(heads, "h").where("g <> to AND component <> its").join(held_by_groups(places), ["h", "to"]).where(may_link(percent)).select("digest", "to").distinct()


def other_groups(places: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """(digest, to): each query and all later groups with one of its first tokens that aren't known to be of its component."""
    known = with_component(places, parts)
    held = known.groupBy("h", F.col("g").alias("to")).agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n") - F.col("place")).alias("most_after"), F.max("shared").alias("most_shared"),
        F.min("component").alias("least_part"), F.max("component").alias("last_part"),
    )
    apart = held.groupBy("h").agg(F.min("least_part").alias("a"), F.max("last_part").alias("z"), F.count("*").alias("k")).where("k > 1 AND a <> z").select("h")
    asked = known.join(apart, "h").join(held.join(apart, "h"), "h").where("g < to AND NOT (least_part = component AND last_part = component)")
    return asked.where(may_link(percent)).select("digest", "to").distinct()


def set_components(members: DataFrame, percent: int) -> DataFrame:
    """(node, component) of every digest that is linked with another."""
    sets = staged(members.where("kind = 1").select("digest", "n", "shared", "least", "tokens", "prefix").dropDuplicates(["digest"]), "sets")
    grouped = staged(in_groups(sets), "grouped-sets")
    discard(sets)
    with arrow_rows(members.sparkSession, 500):
        groups = staged(group_rows(grouped, percent), "groups")
    places = query_places(grouped.drop("tokens"))
    # Tokens of one set lead nowhere.
    places = staged(places.join(places.groupBy("h").agg(F.count("*").alias("k")).where("k > 1").select("h"), "h"), "places")
    parts = connected_components(member_links(groups))
    before = None
    for ask in (first_groups, other_groups):
        asked = ask(places, parts, percent)
        asked = staged(asked if before is None else asked.join(before, ["digest", "to"], "left_anti"), "asked")
        if not asked.isEmpty():
            links = opened_links(asked, grouped, groups, percent)
            joined = staged(parts.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(links), "joined")
            newer = connected_components(joined)
            for spent in (parts, links, joined):
                discard(spent)
            parts = newer
        if before is not None:
            discard(before)
        before = asked
    for spent in (before, places, groups, grouped):
        discard(spent)
    return parts


def similarity_classes(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, text_key, digest, n_shingles, class (digest of the least linked set).

    docs needs doc_id and text; other columns are ignored. Documents with equal shingle sets
    are one class; classes are linked where 100 * |intersection| >= percent * |union|; class
    is the component. Documents without words (null or blank text) have n_shingles 0 and are
    each alone: their class is null. An empty table gives no rows. Sets are told apart by
    128-bit hashes, the shingles of a pair by 41 bits or more.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    members = members_of(docs, size, percent)
    parts = set_components(members, percent)
    nodes = members.where("kind = 0").select("doc_id", "text_key", "digest", F.col("n").alias("n_shingles"))
    labelled = nodes.join(parts.withColumnRenamed("node", "digest"), "digest", "left")
    out = staged(labelled.select("doc_id", "text_key", "digest", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "digest")).alias("class")), "classes")
    discard(members)
    discard(parts)
    return out


def linked_documents(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id: the least doc_id reachable by links, itself included.

    A null doc_id gets the least id of its class, or null where none has an id.
    """
    c = similarity_classes(docs, size, percent)
    least = c.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("component_id"))
    out = c.join(least, "class", "left")
    return out.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """docs with one document of each class: the one of the least doc_id, then of the least text
    hash. Documents without words stay; rows equal in both doc_id and text stay or go together."""
    c = similarity_classes(docs, size, percent)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    best = c.where("class IS NOT NULL").groupBy("class").agg(F.min(order).alias("best"), F.count("*").alias("k")).where("k > 1")
    lost = staged(c.join(best, "class").where(order != F.col("best")).select("doc_id", "text_key").distinct(), "lost")
    discard(c)
    key = hidden()
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    return without_rows(keyed, {"doc_id": F.col("doc_id").cast("long"), "text_key": F.col(key)}, lost).select(*docs.columns)
