"""N-gram Jaccard join: a size-aware heavy-light set-similarity join."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, drop, one_each, release, saved, table, without
from .components import components
from .texthash import mix, shingles, word_hashes

#: Similarity as a fraction, so that all tests are in whole numbers.
NUM, DEN = 80, 100
#: Words of a shingle.
N = 5
#: Sizes whose counts the boundary between small and large sets is chosen by. A set of more has over
#: 2**29 subsets of the least overlap with its like, so no boundary there costs least.
COUNTED = 64
#: Shingles of known frequency. The table orders tokens; without an entry one counts as rare. It
#: changes which lists are long, never which pairs link.
ORDERED = 200_000
#: A shingle enters the table's counts from so many sets in one block of a task, so that a count is
#: short by under FREQUENT / BLOCK of all shingles.
FREQUENT = 4
BLOCK = 2_000_000
#: About so many sets of a list lead it in the first round after the one with one leader; times STEP in each next.
LEADERS, STEP = 32, 64
#: Subsets of a small set worked on, and about so many postings sent, at once.
SUBSETS, SENT = 1 << 13, 1 << 17
#: Tokens of a set by which one of the lists that it shares with another set is named.
WITNESSES = 4
#: Bits of the filter that says which sets to fetch.
MOST_BITS = 1 << 27
#: Longs of the short bitmap that lists carry; the long one has at least twice as many bits.
WORDS = 8


def least_overlap(a: int, b: int) -> int:
    """The smallest intersection at which sets of sizes a and b link."""
    return -(-NUM * (a + b) // (DEN + NUM))


def partners(n: int) -> range:
    """Sizes of sets that one of size n can link with."""
    return range(-(-NUM * n // DEN), DEN * n // NUM + 1)


def prefix_length(n: int) -> int:
    return n - (-(-NUM * n // DEN)) + 1


def subset_sizes(n: int, boundary: int) -> set[int]:
    return {least_overlap(n, m) for m in partners(n) if m <= boundary}


def choose_boundary(sizes: dict[int, int], list_length: float) -> int:
    """The greatest size whose sets are handled by subsets: where that costs least.

    A small set costs one row for each of its subsets; a large one a row for each prefix token
    and, for each, the length of the list that it is then compared within. Every size that
    ``sizes`` counts is tried.
    """
    best, at = math.inf, 0
    for boundary in range(max(sizes, default=0) + 1):
        light = sum(count * sum(math.comb(n, c) for c in subset_sizes(n, boundary)) for n, count in sizes.items() if n <= boundary)
        heavy = sum(count * prefix_length(n) * list_length for n, count in sizes.items() if DEN * n // NUM > boundary)
        if light + heavy < best:
            best, at = light + heavy, boundary
    return at


def _identity(s: np.ndarray, salt: int) -> tuple[int, int]:
    d = hashlib.blake2b(s.tobytes(), digest_size=16, salt=salt.to_bytes(8, "little")).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def bitmap(s: np.ndarray) -> bytes:
    """One bit for each of as many hash values as the set has items, up to a power of two."""
    size = max(64 * WORDS * 2, 1 << max(len(s) - 1, 0).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(s.view(np.uint64) >> np.uint64(20)) % np.uint64(size)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A number of items that the sets of two bitmaps differ in at least."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    n = min(len(a), len(b))
    a, b = (np.bitwise_or.reduce(v.reshape(-1, n)) for v in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def _sets(b: pa.RecordBatch):
    return shingles(*word_hashes(b.column("text")), N)


def _survey(salt: int):
    """Rows of two kinds: (doc_id, key, n, sid, proof, bits, words) for each document, (h, c) for frequent shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()

        def counted() -> pa.RecordBatch:
            h, c = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.int64),) * 2
            h, c = h[c >= FREQUENT], c[c >= FREQUENT]
            none = pa.nulls(len(h), pa.int64())
            return pa.RecordBatch.from_arrays(
                [none, pa.nulls(len(h), pa.binary()), none.cast(pa.int32()), none, none, pa.nulls(len(h), pa.binary()), pa.nulls(len(h), pa.list_(pa.int64())), pa.array(h), pa.array(c.astype(np.int64))], names
            )

        names = ["doc_id", "key", "n", "sid", "proof", "bits", "words", "h", "c"]
        for b in batches:
            n, sid, proof, bits, words = [], [], [], [], []
            for s in _sets(b):
                i, j = _identity(s, salt)
                n.append(len(s))
                bits.append(bitmap(s))
                short = np.bitwise_or.reduce(np.frombuffer(bits[-1], np.int64).reshape(-1, WORDS))
                words.append(short.tolist())
                sid.append(i)
                proof.append(j)
                if i not in seen:
                    seen.add(i)
                    held.append(s)
                    size += len(s)
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("key"), pa.array(n, pa.int32()), pa.array(sid, pa.int64()), pa.array(proof, pa.int64()), pa.array(bits, pa.binary()), pa.array(words, pa.list_(pa.int64())), none, none],
                names,
            )
            if size > BLOCK:
                yield counted()
                held, size, seen = [], 0, set()
        yield counted()

    return run


@lru_cache(maxsize=256)
def _few_subsets(n: int, c: int) -> np.ndarray:
    return np.array(list(combinations(range(n), c)), np.uint8)


def _subsets(n: int, c: int) -> Iterator[np.ndarray]:
    """Places of all subsets of ``c`` out of ``n`` items, SUBSETS of them at a time."""
    if math.comb(n, c) <= SUBSETS:
        yield _few_subsets(n, c)
        return
    every = combinations(range(n), c)
    while some := list(islice(every, SUBSETS)):
        yield np.array(some, np.uint8)


def _postings(order, boundary: int, salt: int):
    """(h, sid, n, pos): prefix tokens of large sets, and keys of subsets (pos -1) of small ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, frequency = order.value
        seen = set()
        out: list[list] = [[], [], [], []]
        rows = 0

        def add(keys, sid, n, pos):
            nonlocal rows
            rows += len(keys)
            out[0].append(keys)
            out[1].append(np.full(len(keys), sid))
            out[2].append(np.full(len(keys), n, np.int32))
            out[3].append(pos.astype(np.int32))

        def batch() -> pa.RecordBatch:
            nonlocal out, rows
            sent, out, rows = out, [[], [], [], []], 0
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in sent], ["h", "sid", "n", "pos"])

        for b in batches:
            for s in _sets(b):
                n = len(s)
                if not n:
                    continue
                sid, _ = _identity(s, salt)
                if sid in seen:  # copies in one task need one row
                    continue
                seen.add(sid)
                if n <= boundary:
                    for c in subset_sizes(n, boundary):
                        for which in _subsets(n, c):
                            keys = mix(mix(s.view(np.uint64))[which].sum(axis=1) + np.uint64(c)).view(np.int64)
                            add(keys, sid, n, np.full(len(keys), -1))
                            if rows > SENT:
                                yield batch()
                if DEN * n // NUM > boundary:
                    p = prefix_length(n)
                    if len(known):
                        i = np.minimum(np.searchsorted(known, s), len(known) - 1)
                        f = np.where(known[i] == s, frequency[i], 0)
                        rare = s[f == 0][:p]
                        if len(rare) < p:
                            hot = f > 0
                            rare = np.concatenate([rare, s[hot][np.lexsort((s[hot], f[hot]))][: p - len(rare)]])
                    else:
                        rare = s[:p]
                    add(rare, sid, n, np.arange(p))
                if rows > SENT:
                    yield batch()
        if rows:
            yield batch()

    return run


def _bits(ids: np.ndarray, size: int) -> np.ndarray:
    h = mix(ids.view(np.uint64))
    return np.stack([(mix(h + np.uint64(k)) % np.uint64(size)).astype(np.int64) for k in range(4)])


def _filter_of(ids: DataFrame) -> tuple[np.ndarray, int]:
    """A Bloom filter of at most MOST_BITS over one long column: a false hit only costs time."""
    size = 1 << 14
    count = ids.count()
    while size < 16 * count and size < MOST_BITS:
        size *= 2

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size >> 3, np.uint8)
        for b in batches:
            at = np.unique(_bits(b.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), size))
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        eight = bits.view(np.int64)
        at = np.flatnonzero(eight)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(eight[at])], ["word", "bits"])

    got = ids.mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    eight = np.zeros(size >> 6, np.int64)
    eight[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return eight.view(np.uint8), size


def _fetch(bloom, size: int, salt: int):
    """(sid, items) of the documents that the filter names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bloom.value
        for b in batches:
            ids = b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = _bits(ids, size)
            keep = np.all(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1, axis=0)
            if keep.any():
                b = b.filter(pa.array(keep))
                sets = [s for s in _sets(b) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_identity(s, salt)[0] for s in sets], pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["sid", "items"],
                )

    return run


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n = [b.column(c).to_pylist() for c in ("n_a", "n_b")]
        keep = [
            least_difference(x.as_py(), y.as_py()) <= i + j - 2 * least_overlap(i, j)
            for i, j, x, y in zip(*n, b.column("bits_a"), b.column("bits_b"), strict=True)
        ]
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], ["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = []
        for x, y in zip(b.column("items_a"), b.column("items_b"), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(DEN * both >= NUM * (len(x) + len(y) - both))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], ["a", "b"])


def _rooted(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """``lists`` with the root of each set, without the lists whose sets all have one."""
    labelled = saved(
        lists.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid")), "labelled"
    )
    spread = labelled.groupBy("h").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r != s").select("h")
    out = saved(labelled.join(spread, "h", "left_semi"), "lists")
    drop(labelled)
    return out


def _links(lists: DataFrame, bitmaps: DataFrame, fetch) -> DataFrame:
    """(node, root) of sets that link, from ``lists`` (h, sid, n, pos).

    A list of k sets never gives its k * k pairs at once. First each list's sets are compared with
    one of them, the first by a hash of its name, which is the same set in most lists of a group.
    In each round after that some sets of every list, picked by the same hash, are its leaders and
    are compared with the list's other sets; leaders of earlier rounds are done with. Pairs already
    in one component are left out, and a list whose sets all are is dropped. The rounds' leaders
    grow until lists are exhausted, so every pair either was compared or is in one component by
    other links.

    Near copies share most of their lists. A pair is looked at in one of them where it can be told:
    a set's witnesses are its least tokens by WITNESSES residues, and a pair with an equal witness
    is looked at in the list of the first such token alone, which both sets are in.
    """
    u = (F.pmod(F.xxhash64("sid"), F.lit(1 << 30)) / float(1 << 30)).alias("u")
    own = ["u", "sid", "n", "pos"]
    lists = lists.select("h", u, "sid", "n", "pos")
    heads = saved(lists.groupBy("h").agg(F.min(F.struct(*own)).alias("x"), F.count("*").alias("k")), "heads")
    star = heads.select("h", *(F.col(f"x.{c}").alias(f"{c}_x") for c in own)).join(_other(lists), "h").where(_able())
    words = [f"w{i}" for i in range(WORDS)]
    short = bitmaps.select("sid", "n", *(F.col("words")[i].alias(w) for i, w in enumerate(words)))
    star = saved(_pairs(star), "star")
    found = _confirmed(_both(star, short, ["n", *words], "x", "y").where(_near()).select("a", "b"), bitmaps, fetch)
    roots = components(found)
    drop(star)
    drop(found)
    release(lists.sparkSession)

    residue = F.pmod(F.xxhash64("h"), F.lit(WITNESSES))
    witness = lists.groupBy("sid").agg(*(F.min(F.when(residue == i, F.col("h"))).alias(f"m{i}") for i in range(WITNESSES)))
    now = _rooted(lists.join(heads.where("k > 2").select("h", "k"), "h"), roots)
    carried = now.join(witness, "sid").join(short.drop("n"), "sid")
    now, before = saved(carried, "carried"), now
    for x in (before, heads):
        drop(x)
    own += ["root", *(f"m{i}" for i in range(WITNESSES)), *words]
    done, leaders = 0, LEADERS
    while now.limit(1).count():
        place = F.col("u") * F.col("k")
        lead = now.where((place >= done) & (place < leaders)).select("h", *(F.col(c).alias(f"{c}_x") for c in own))
        named = reduce(
            lambda rest, i: F.when(F.col(f"m{i}_x") == F.col(f"m{i}_y"), F.col("h") == F.col(f"m{i}_x")).otherwise(rest),
            reversed(range(WITNESSES)), F.lit(True),
        )
        met = lead.join(_other(now.where(place >= done).select("h", *own)), "h").where(_able() & (F.col("root_x") != F.col("root_y")) & named & _near())
        found = _confirmed(_pairs(met), bitmaps, fetch)
        known = roots.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(found.unionByName(known))
        before, now = now, _rooted(now.where(F.col("k") > leaders).drop("root"), roots)
        drop(before)
        drop(found)
        release(lists.sparkSession)
        done, leaders = leaders, leaders * STEP
    drop(now)
    return roots


def _other(members: DataFrame) -> DataFrame:
    return members.select("h", *(F.col(c).alias(f"{c}_y") for c in members.columns if c != "h"))


def _able():
    """x stands before y, and lengths and places in the list allow for a link. Pairs go by the order of (u, sid)."""
    before = F.struct("u_x", "sid_x") < F.struct("u_y", "sid_y")
    few, many = F.least("n_x", "n_y"), F.greatest("n_x", "n_y")
    room = F.least("pos_x", "pos_y") + F.least(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y"))
    enough = (F.col("pos_x") < 0) | (room * (DEN + NUM) >= (F.col("n_x") + F.col("n_y")) * NUM)
    return before & (few * DEN >= many * NUM) & enough


def _near():
    """Whether short bitmaps differ in no more bits than sets that link can differ in items."""
    both = F.col("n_x") + F.col("n_y")
    differ = reduce(lambda a, b: a + b, [F.bit_count(F.col(f"w{i}_x").bitwiseXOR(F.col(f"w{i}_y"))) for i in range(WORDS)])
    return differ <= both - 2 * F.ceil(both * NUM / (DEN + NUM))


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("sid_x", "sid_y").alias("a"), F.greatest("sid_x", "sid_y").alias("b")).distinct()


def _both(pairs: DataFrame, table: DataFrame, columns: list[str], *suffixes: str) -> DataFrame:
    """``pairs`` (a, b) with ``columns`` of ``table`` (sid, ...) for either side."""
    for side, suffix in zip(("a", "b"), suffixes, strict=True):
        pairs = pairs.join(table.select(F.col("sid").alias(side), *(F.col(c).alias(f"{c}_{suffix}") for c in columns)), side)
    return pairs


def _confirmed(pairs: DataFrame, bitmaps: DataFrame, fetch) -> DataFrame:
    """The ``pairs`` (a, b) of sets that link, compared exactly. Long bitmaps rule most others out; only sets of the rest are fetched."""
    likely = saved(_both(pairs, bitmaps, ["n", "bits"], "a", "b").mapInArrow(_plausible, "a long, b long"), "pairs")
    release(pairs.sparkSession)
    sets = fetch(likely.select(F.col("a").alias("sid")).unionByName(likely.select(F.col("b").alias("sid"))).distinct())
    out = saved(_both(likely, sets, ["items"], "a", "b").mapInArrow(_verify, "a long, b long"), "links")
    drop(sets)
    drop(likely)
    return out


def _classed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n, sid, root) of every row of ``docs`` (doc_id, key, text); root is null without shingles."""
    spark = docs.sparkSession
    bounded_batches(spark)
    for salt in range(8):
        survey = saved(
            docs.mapInArrow(_survey(salt), "doc_id long, key binary, n int, sid long, proof long, bits binary, words array<long>, h long, c long"), "survey"
        )
        names = survey.where("sid is not null").groupBy("sid").agg(F.min("proof").alias("p"), F.max("proof").alias("q"))
        if not names.where("p != q").limit(1).count():
            break
        drop(survey)
    else:
        raise RuntimeError("set names collide under every salt")
    docs = docs.select("doc_id", "text")
    members = survey.where("sid is not null").select("doc_id", "key", "n", "sid")
    frequent = survey.where("h is not null").groupBy("h").agg(F.sum("c").alias("c"))
    got = frequent.orderBy(F.desc("c"), "h").limit(ORDERED).toArrow()
    known, c = got.column("h").to_numpy(), got.column("c").to_numpy()
    at = np.argsort(known)
    known, c = known[at], c[at]
    sizes = {r.n: r.k for r in members.where(f"n between 1 and {COUNTED}").groupBy("n").agg(F.count("*").alias("k")).collect()}
    total = members.agg(F.sum("n").alias("n")).first().n or 0
    boundary = choose_boundary(sizes, 1 + float((c.astype(float) ** 2).sum()) / max(total, 1))

    order = spark.sparkContext.broadcast((known, c))
    postings = docs.mapInArrow(_postings(order, boundary, salt), "h long, sid long, n int, pos int")
    shared = postings.groupBy("h").agg(F.min("sid").alias("s"), F.max("sid").alias("t")).where("s != t").select("h")
    repeated = saved(postings.join(shared, "h", "left_semi"), "postings")
    release(spark)
    lists = saved(repeated.dropDuplicates(["h", "sid"]), "lists")
    drop(repeated)

    bits = survey.where("sid is not null").select("sid", "n", "bits", "words").join(lists.select("sid").distinct(), "sid", "left_semi")
    bitmaps = saved(bits.dropDuplicates(["sid"]), "bitmaps")
    release(spark)

    def fetch(named: DataFrame) -> DataFrame:
        """(sid, items) of the sets in ``named``, worked out anew from one document of each."""
        first = members.join(named, "sid", "left_semi").groupBy("sid").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
        bits, size = _filter_of(first)
        sets = docs.mapInArrow(_fetch(spark.sparkContext.broadcast(bits), size, salt), "sid long, items binary")
        return saved(sets.dropDuplicates(["sid"]), "sets")

    roots = _links(lists, bitmaps, fetch)
    for x in (bitmaps, lists):
        drop(x)
    return members.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn(
        "root", F.when(F.col("n") > 0, F.coalesce("root", "sid"))
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Sets of distinct 5-word shingles (fewer words: all of them as one) link at a Jaccard
    similarity of 0.8 or more; component_id is the smallest doc_id reachable by links. A null or
    empty text, or one of white space alone, has no shingles and links with nothing. Rows of one
    doc_id with the same text are one document; with other texts they are documents of their own.
    A null doc_id is in no order, so a class of null ids alone has a null component_id. Other
    columns are ignored; an empty table gives no rows. All pairs that link are found: the join has
    no caps and every candidate is compared exactly.

    Equal sets are one set from the start, under a 64-bit name of which it is proved, with 64
    more bits, that no two sets here share it. Sets up to a boundary size are joined on their
    subsets of the smallest size that a linking pair shares; larger ones on the tokens of their
    prefix, rarest first, with length and positional filters. The boundary is chosen by cost.
    """
    placed = _classed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("key"), "text"))
    least = placed.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "root", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")
    )


def keep_representatives(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class of near duplicates, with all columns.

    It is the row with the smallest doc_id (null last); where several texts have that id, the one
    whose set and then whose text has the smallest hash. A row is known by its doc_id and its text,
    so other rows of its id, or of no id, stay where their own texts link with nothing. Rows that
    repeat both are one document and one of them stays. Texts without shingles stay.
    """
    key = {"__helix_id": F.col("doc_id").cast("long"), "__helix_key": F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))}
    keyed = docs.withColumns(key)
    placed = saved(_classed(keyed.select(F.col("__helix_id").alias("doc_id"), F.col("__helix_key").alias("key"), "text")), "placed")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sid", "key")
    best = placed.where("root is not null").groupBy("root").agg(F.min(row).alias("best"))
    lost = placed.join(best, "root").where(~row.eqNullSafe(F.col("best"))).select(F.col("doc_id").alias("__helix_id"), F.col("key").alias("__helix_key"))
    lost = saved(lost.distinct(), "lost")
    rows = placed.groupBy(F.col("doc_id").alias("__helix_id"), F.col("key").alias("__helix_key")).agg(F.count("*").alias("rows"))
    repeated = saved(rows.where("rows > 1").drop("rows"), "repeated")
    drop(placed)
    names = list(key)
    return one_each(without(keyed, lost, names), repeated, names).drop(*names)


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
