"""Near-duplicates by an inverted index over MinHash signature coordinates.

A document's set holds its distinct shingles of four words; documents with
equal sets are one class, of which the smallest id stands for all.  Every
class has a signature of ``k`` coordinates, each the minimum of another hash
of the set, and is posted under each (coordinate, value) that some other
class has too.

Two classes with at least ``matches`` equal coordinates must meet in their
prefixes, the ``k - matches + 1`` rarest postings of each (prefix filter over
the corpus frequencies; a value that no other class has counts as rarest and
needs no posting).  So common passages, which fill long lists, are skipped
unless nearly the whole signature is common.  Classes that meet have their
collisions counted over all coordinates; pairs with ``matches`` or more are
confirmed on the full sets.

Lists may still be long, for thousands of near copies.  No list is expanded
into all its pairs: every member is paired with the most typical class of each
of its lists, and confirmed pairs join to components.  A link inside a component
changes nothing, so only members of lists that still hold several components
are looked at again, now by their full sets: each set is ordered by rising
frequency among these members, and a shingle is posted only while a pair can
still be similar if it is the first one that both have (prefix and length
filters: both sets must have as many shingles left as the two sizes ask for).
In each list the members outside its largest component meet the others of
other components, never the largest component itself.  These filters are
exact, so no link that the signatures show is lost.

Sets are made only of classes that have a partner in the index, and rows go to a
shuffle only if a Bloom filter of the shared values has them.  The filter has 8
bits a value and at most ``BLOOM_BITS`` = 2**28 (32 MB); what it lets through
in vain is taken out by the join behind it, so a fuller filter costs time only.
Intermediates are tables in the checkpoint folder, deleted once they are read.

With k = 64 and matches = 36, a pair at the limit 0.8 has 51 equal
coordinates on average and fewer than 36 with a probability of 4.2e-6
(binomial; 1.4e-6 at 0.81).  Such a pair is not found.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import map_arrow, utf8_values
from tillroll.session import Scope

WORDS, SIMILARITY = 4, 0.8
COORDINATES, MATCHES = 64, 36
MAX_ROUNDS = 100
BLOOM_BITS, BLOOM_BITS_EACH, BLOOM_HASHES = 1 << 28, 8, 2

_rng = np.random.default_rng(20_240_501)
_MIX = (_rng.integers(1, 1 << 62, 16, np.uint64) << np.uint64(1)) | np.uint64(1)


def _spread(h: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(31))) * _MIX[14]
    h = (h ^ (h >> np.uint64(29))) * _MIX[15]
    return h ^ (h >> np.uint64(32))


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text (UTF-8).

    Words are runs of anything but ASCII white space, A-Z lower-cased; a text
    of fewer words is one shingle, one without words has none.
    """
    import xxhash

    found = text.lower().split()
    n = len(found)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, n)
    size = min(n, words)
    total = np.full(n - size + 1, int(_MIX[13]) * size & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for i in range(size):
        total += _spread(h[i:n - size + 1 + i] ^ _MIX[i]) * _MIX[i]
    return np.unique(_spread(total))


def _coefficients(k: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    draw = lambda: rng.integers(0, 1 << 63, k, np.uint64)
    return (draw() << np.uint64(1)) | np.uint64(1), draw()


def signature(shingles: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """``k`` 32-bit minima; ``shingles`` is not empty."""
    a, b = _coefficients(k)
    best = np.full(k, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at:at + 4096]
        best = np.minimum(best, ((a[:, None] * part + b[:, None]) >> np.uint64(32)).min(axis=1))
    return best.astype(np.uint32)


def jaccard(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of the intersection and the union of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum()) if len(b) else 0
    return both, len(a) + len(b) - both


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int, k: int) -> DataFrame:
    """``id, n, digest, sig`` of every row; ``sig`` holds the coordinates as
    32-bit numbers, ``digest`` identifies the set (null: empty)."""
    id_type = dict(docs.select(id_col).dtypes)[id_col]

    def run(batches):
        for batch in batches:
            n, digests, sigs = [], [], []
            for text in utf8_values(batch.column(1)):
                s = shingle_set(text, words)
                n.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sigs.append(signature(s, k).astype("<u4").tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(sigs, pa.binary())], ["id", "n", "digest", "sig"])

    return map_arrow(docs.select(docs[id_col], docs[text_col]), run,
                     f"id {id_type}, n bigint, digest binary, sig binary")


def full_sets(docs: DataFrame, id_col: str, text_col: str, words: int, wanted: Bloom) -> DataFrame:
    """``id, shingles`` (sorted 64-bit hashes as bytes) of the rows that the filter has."""
    id_type = dict(docs.select(id_col).dtypes)[id_col]

    def run(batches):
        for batch in batches:
            at = pa.array(np.flatnonzero(wanted.has(batch.column(2).to_numpy())))
            sets = [shingle_set(t, words).tobytes() for t in utf8_values(batch.column(1).take(at))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(sets, pa.binary())], ["id", "shingles"])

    return map_arrow(docs.select(docs[id_col], docs[text_col], F.xxhash64(docs[id_col])), run,
                     f"id {id_type}, shingles binary")


class Bloom:
    """A Bloom filter of 64-bit numbers, of a size bounded by ``BLOOM_BITS``."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    @staticmethod
    def places(x: np.ndarray, bits: int) -> list[np.ndarray]:
        h = _spread(x.astype(np.int64).view(np.uint64) * _MIX[12])
        return [((h >> np.uint64(32 * i)) & np.uint64(0xFFFFFFFF)) % np.uint64(bits) for i in range(BLOOM_HASHES)]

    @classmethod
    def of(cls, values: DataFrame, column: str, count: int) -> Bloom:
        """Of a BIGINT column with about ``count`` values: each task sets the bits
        of its rows, and equal words of the tasks are united in a shuffle."""
        bits = 1 << 16
        while bits < min(count * BLOOM_BITS_EACH, BLOOM_BITS):
            bits *= 2

        def run(batches):
            words = np.zeros(bits // 64, np.uint64)
            for batch in batches:
                for place in cls.places(batch.column(0).to_numpy(), bits):
                    np.bitwise_or.at(words, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
            at = np.flatnonzero(words)
            for low in range(0, len(at), 1 << 16):
                part = at[low:low + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(words[part].view(np.int64))],
                                                 ["word", "value"])

        rows = map_arrow(values.select(column), run, "word bigint, value bigint").groupBy("word").agg(F.bit_or("value").alias("value"))
        found = rows.toArrow()
        words = np.zeros(bits // 64, np.uint64)
        words[found["word"].to_numpy()] = found["value"].to_numpy().view(np.uint64)
        return cls(bits, words)

    def has(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for place in self.places(x, self.bits):
            out &= (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0
        return out


def _keys(batch_column: pa.Array, k: int) -> np.ndarray:
    """(rows, k) postings of signatures: the coordinate's number and its value."""
    values = np.frombuffer(b"".join(batch_column.to_pylist()), "<u4").reshape(-1, k).astype(np.int64)
    return (np.arange(k, dtype=np.int64) << 32) | values


def index(classes: DataFrame, k: int, matches: int, scope: Scope) -> tuple[DataFrame, DataFrame]:
    """Classes that may have a partner.

    Returns ``id, prefix, weight``: the keys under which they are posted (the
    rarest of those shared with others), and the sum of the shared keys'
    frequencies, which says how typical the class is; and ``id, sig`` of these
    classes and a few more.
    """
    id_type = dict(classes.dtypes)["id"]

    def post(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_keys(batch.column(0), k).ravel())], ["key"])

    shared = (map_arrow(classes.select("sig"), post, "key bigint").groupBy("key").agg(F.count(F.lit(1)).alias("f"))
              .where("f > 1"))
    shared = scope.keep(shared, "minhash-shared")
    filled = Bloom.of(shared, "key", shared.count())

    def passing(batch):
        keys = _keys(batch.column(1), k)
        has = filled.has(keys.ravel()).reshape(keys.shape)
        has[has.sum(axis=1) < matches] = False
        return keys, has

    def posted(batches):
        for batch in batches:
            keys, has = passing(batch)
            row, _ = np.nonzero(has)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(keys[has])], ["id", "key"])

    def held(batches):
        for batch in batches:
            at = pa.array(np.flatnonzero(passing(batch)[1].any(axis=1)))
            yield pa.RecordBatch.from_arrays([c.take(at) for c in batch.columns], ["id", "sig"])

    classes = classes.select("id", "sig")
    lists = map_arrow(classes, posted, f"id {id_type}, key bigint").join(shared.withColumnRenamed("key", "shared"), F.col("key") == F.col("shared"))
    lists = (lists.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("f", "key"))).alias("l"), F.sum("f").alias("weight"))
             .where(F.size("l") >= matches))
    found = lists.select("id", "weight", F.slice(F.col("l.key"), F.lit(1), F.size("l") - matches + 1).alias("prefix"))
    return (scope.keep(found, "minhash-found"),
            scope.keep(map_arrow(classes, held, f"id {id_type}, sig binary"), "minhash-held"))


def _filter_pairs(pairs: DataFrame, values: DataFrame, value: str, test) -> DataFrame:
    """The pairs ``a, b`` whose ``values`` rows (by id) pass ``test(x, y)`` on lists of bytes."""
    both = (pairs.join(values.select(F.col("id").alias("a"), F.col(value).alias("va")), "a")
            .join(values.select(F.col("id").alias("b"), F.col(value).alias("vb")), "b").select("a", "b", "va", "vb"))
    id_type = dict(both.dtypes)["a"]

    def run(batches):
        for batch in batches:
            at = pa.array(np.flatnonzero(test(batch.column(2).to_pylist(), batch.column(3).to_pylist())))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], ["a", "b"])

    return map_arrow(both, run, f"a {id_type}, b {id_type}")


def colliding(pairs: DataFrame, held: DataFrame, k: int, matches: int) -> DataFrame:
    """The pairs with at least ``matches`` equal coordinates."""

    def test(x, y):
        x, y = (np.frombuffer(b"".join(v), "<u4").reshape(-1, k) for v in (x, y))
        return (x == y).sum(axis=1) >= matches

    return _filter_pairs(pairs, held, "sig", test)


def confirm(pairs: DataFrame, sets: DataFrame, similarity: float, few: bool = False) -> DataFrame:
    """The pairs whose full sets are similar enough.

    Both sides of each join are plain shuffles, so adaptive execution can split
    the pairs of a class that thousands are paired with.  ``few`` pairs first
    pick the sets that they need.
    """
    hundredths = round(100 * similarity)
    if few:
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        sets = sets.join(wanted, "id", "left_semi")

    def test(x, y):
        out = np.zeros(len(x), bool)
        for i, (a, b) in enumerate(zip(x, y)):
            common, union = jaccard(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64))
            out[i] = hundredths * union <= 100 * common
        return out

    return _filter_pairs(pairs, sets, "shingles", test)


def components(links: DataFrame, scope: Scope) -> DataFrame:
    """Smallest reachable id of every linked id: ``id, component``.

    Alternates two steps that keep the components and flatten them to stars
    around their smallest id: every node's larger neighbours are linked to its
    smallest one, then every node's smaller neighbours and itself.  The round
    ends when nothing changes; each round is a written table.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges = scope.keep(edges, "minhash-edges")
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        edges = (both.join(least, both["u"] == least["w"]).where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select(F.col("u").alias("w"), "m")
        edges = (edges.join(least, edges["u"] == least["w"])
                 .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                         F.col("m").alias("v")).distinct())
        edges = scope.keep(edges, "minhash-edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 30))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _with_component(found: DataFrame, links: DataFrame, scope: Scope) -> DataFrame:
    comp = components(links, scope).withColumnRenamed("id", "cid")
    return found.join(comp, found["id"] == comp["cid"], "left").withColumn(
        "component", F.coalesce("component", "id")).drop("cid")


def class_links(classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, words: int, similarity: float,
                k: int, matches: int, scope: Scope) -> DataFrame:
    """Confirmed links ``a, b`` that connect all components of the classes."""
    found, held = index(classes, k, matches, scope)
    wanted = Bloom.of(found.select(F.xxhash64("id").alias("h")), "h", found.count())
    sets = scope.keep(full_sets(docs, id_col, text_col, words, wanted), "minhash-sets")

    # everyone with the most typical class of each of its lists
    posted = found.select("id", "weight", F.explode("prefix").alias("key"))
    leaders = (posted.groupBy("key").agg(F.min(F.struct((-F.col("weight")).alias("w"), "id")).alias("top"),
                                         F.count(F.lit(1)).alias("n"))
               .where("n > 1").select(F.col("key").alias("lead_key"), F.col("top.id").alias("lead")))
    first = (posted.join(leaders, posted["key"] == leaders["lead_key"]).where(F.col("id") != F.col("lead"))
             .select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct())
    first = scope.keep(colliding(first, held, k, matches), "minhash-pairs")
    links = scope.keep(confirm(first, sets, similarity), "minhash-links")

    # members of lists that hold several components, by their full sets
    labelled = scope.keep(_with_component(found, links, scope), "minhash-labelled")
    posted = labelled.select("id", "component", F.explode("prefix").alias("key"))
    mixed = (posted.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low < high").select(F.col("key").alias("mixed")))
    left = posted.join(mixed, posted["key"] == mixed["mixed"]).select("id", "component").distinct()
    more = similar_pairs(sets, scope.keep(left, "minhash-left"), similarity, scope)
    return scope.keep(links.unionByName(confirm(more, sets, similarity, few=True)), "minhash-links")


def similar_pairs(sets: DataFrame, members: DataFrame, similarity: float, scope: Scope) -> DataFrame:
    """Pairs ``a, b`` of different components among ``members`` (``id,
    component``) that prefixes and sizes of the full sets don't exclude."""
    hundredths = round(100 * similarity)
    id_type = dict(sets.dtypes)["id"]
    chosen = scope.keep(sets.join(members, "id").select("id", "component", "shingles"), "minhash-members")

    def values(wanted=None):
        def run(batches):
            for batch in batches:
                found = [np.frombuffer(x, np.int64) for x in batch.column(2).to_pylist()]
                size = np.array([len(x) for x in found], np.int64)
                at, all_ = np.repeat(np.arange(len(found)), size), np.concatenate([*found, np.zeros(0, np.int64)])
                if wanted is not None:
                    has = wanted.has(all_)
                    at, all_ = at[has], all_[has]
                for low in range(0, len(at), 1 << 16):
                    part = at[low:low + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(part)), batch.column(1).take(pa.array(part)),
                         pa.array(size[part]), pa.array(all_[low:low + (1 << 16)])], ["id", "component", "n", "shingle"])

        return map_arrow(chosen, run, f"id {id_type}, component {id_type}, n bigint, shingle bigint")

    shared = values().groupBy("shingle").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    shared = scope.keep(shared, "minhash-shared-shingles")
    filled = Bloom.of(shared, "shingle", shared.count())

    # places in the order of rising frequency, from 1; a set's own shingles come first and need no posting
    held = values(filled).join(shared.withColumnRenamed("shingle", "s2"), F.col("shingle") == F.col("s2"))
    held = held.groupBy("id", "component", "n").agg(F.sort_array(F.collect_list(F.struct("f", "shingle"))).alias("l"))
    last = F.col("n") - F.ceil(F.col("n") * hundredths / 100).cast("bigint") + 1
    held = held.withColumn("own", F.col("n") - F.size("l"))
    held = held.withColumn("l", F.slice("l", F.lit(1), F.greatest(last - F.col("own"), F.lit(0)).cast("int")))
    posts = scope.keep(held.select("id", "component", "n", "own", F.posexplode("l").alias("at", "x"))
                       .select("id", "component", "n", F.col("x.shingle").alias("shingle"),
                               (F.col("own") + F.col("at") + 1).alias("place")), "minhash-posts")

    # lists of several components; the largest one of each need not meet itself
    parts = posts.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("m"))
    lists = (parts.groupBy("shingle").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("m", "component")).alias("top"))
             .where("parts > 1").select(F.col("shingle").alias("list"), F.col("top.component").alias("top")))
    # sizes within the similarity of each other fall into the same bucket or neighbours
    bucket = F.floor(F.log("n") / float(-np.log(similarity) + 1e-9)).cast("bigint")
    rows = posts.join(lists, posts["shingle"] == lists["list"]).withColumn("bucket", bucket)
    x = (rows.where(F.col("component") != F.col("top"))
         .select("list", F.explode(F.array(*[F.col("bucket") + d for d in (-1, 0, 1)])).alias("bucket"), F.col("id").alias("x"),
                 F.col("component").alias("cx"), F.col("n").alias("nx"), F.col("place").alias("px")))
    y = rows.select(F.col("list").alias("list2"), F.col("bucket").alias("bucket2"), F.col("id").alias("y"),
                    F.col("component").alias("cy"), F.col("n").alias("ny"), F.col("place").alias("py"))
    # the least common size with which two sets of these sizes are similar
    need = F.ceil((F.col("nx") + F.col("ny")) * hundredths / (100 + hundredths) - 1e-9).cast("bigint")
    may = (F.col("nx") - F.col("px") + 1 >= need) & (F.col("ny") - F.col("py") + 1 >= need)
    pairs = x.join(y, (F.col("list") == F.col("list2")) & (F.col("bucket") == F.col("bucket2"))
                   & (F.col("cx") != F.col("cy")) & may)
    return scope.keep(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "minhash-pairs")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    similarity: float = SIMILARITY, k: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """Components of documents whose shingle sets have a similarity of 0.8 or more.

    One row per input row: the id, ``n_shingles``, ``component_id`` (smallest id
    reachable over links) and ``kept`` (it is its own component id).  A null
    or empty text has an empty set and is linked with nothing; a row with a
    null id is its own and kept; rows with the same id follow their own texts;
    an empty table gives no rows; other columns are not read.  Runs its jobs
    when called; what the result reads stays in the checkpoint folder.
    """
    spark = docs.sparkSession
    result = Scope(spark)
    with Scope(spark) as scope:
        signed = scope.keep(signatures(docs, id_col, text_col, words, k), "minhash-signatures")
        rows = result.keep(signed.select("id", "n", "digest"), "minhash-rows")
        classes = (signed.where(F.col("digest").isNotNull() & F.col("id").isNotNull()).groupBy("digest")
                   .agg(F.min("id").alias("id"), F.first("sig").alias("sig")))
        classes = scope.keep(classes, "minhash-classes")
        links = class_links(classes.select("id", "sig"), docs, id_col, text_col, words, similarity, k, matches, scope)
        named = _with_component(classes.select("id", "digest"), links, scope)
        named = result.keep(named.select(F.col("digest").alias("cd"), "component"), "minhash-named")
    out = rows.select("id", "n", "digest").join(named, (rows["digest"] == named["cd"]) & rows["id"].isNotNull(), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The document with the smallest id of every component, all columns.

    Of rows with the same id all stay that are kept; rows with a null id stay.
    """
    gone = near_duplicates(docs, id_col, text_col, **options).where("not kept")
    gone = gone.select(F.col(id_col).alias("__gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
