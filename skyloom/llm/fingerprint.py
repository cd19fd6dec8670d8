"""Document fingerprints by one-permutation MinHash with optimal densification.

Every shingle is hashed once. The hash names a bin and a value; a bin keeps its least value. An empty bin borrows from
the first filled one in a random order of all bins that is fixed for this bin, so equal sets stay equal and the chance
that two bins agree is the similarity. Of every value the low ``bits`` are stored; the estimate takes off the matches
that so few bits give by chance.

DataFrame operations only. Texts are hashed where they are read; nothing but what a caller joins is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import SPACES, range_parts, saved

BINS, BITS = 128, 8
PROBES = 4


def shingle_hashes(text: Column, k: int = 5, seed: int = 3) -> Column:
    """Array of 64-bit hashes of the ``k``-word shingles; fewer than ``k`` words are one shingle, no words too."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")
    # each word is hashed once; a shingle is the hash of its words' hashes
    return _let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.when(
        F.size(h) >= k, F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(
            *[F.get(h, i + j) for j in range(k)], F.lit(seed)))).otherwise(F.array(F.xxhash64(h, F.lit(seed)))))


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def bin_values(hashes: Column, bins: int = BINS) -> Column:
    """Struct of arrays (bin numbers, least values) of the filled bins, in ascending bins."""
    # the top bits are the bin: in sorted order the first hash of each bin is its least
    shift = 64 - (bins.bit_length() - 1)
    of = lambda x: (F.shiftright(x, shift) + F.lit(bins // 2)).cast("int")  # noqa: E731  ascending, as the signed hashes are
    ranked = F.sort_array(hashes)
    first = lambda h: F.filter(h, lambda x, i: (i == 0) | (of(x) != of(F.get(h, i - 1))))
    return _let(_let(ranked, first), lambda h: F.struct(F.transform(h, of).alias("bin"), h.alias("value")))


def fingerprint(text: Column, k: int = 5, bins: int = BINS, bits: int = BITS) -> Column:
    """Hexadecimal fingerprint: ``bits`` low bits (4, 8 or 16) of each of ``bins`` (a power of two) bins."""
    digits = bits // 4
    low = lambda x: F.lower(F.lpad(F.hex(F.shiftrightunsigned(x, 8).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))),
                                   digits, "0"))

    def probe(b: Column, j: Column | int) -> Column:
        start, stride = F.xxhash64(b, F.lit(1)), F.xxhash64(b, F.lit(2)).bitwiseAND(F.lit(bins // 2 - 1)) * 2 + 1
        return (start.bitwiseAND(F.lit(bins - 1)) + stride * j).bitwiseAND(F.lit(bins - 1)).cast("int")

    numbers = F.sequence(F.lit(0), F.lit(bins - 1))

    def complete(own: Column, dense: Column) -> Column:
        def borrowed(b: Column) -> Column:
            # the first filled bin in the order of b: a few probes as a rule, else the whole order
            order = F.transform(numbers, lambda j: probe(b, j))
            return F.coalesce(*[F.get(dense, probe(b, j)) for j in range(PROBES)],
                              F.get(dense, F.get(F.array_intersect(order, own), F.lit(0))))

        return F.transform(numbers, lambda b: F.coalesce(F.get(dense, b), borrowed(b)))

    def pack(x: Column) -> Column:
        full = F.size(x["bin"]) == bins
        return F.array_join(F.when(full, x["value"]).otherwise(
            _let(_let(F.map_from_arrays(x["bin"], x["value"]),
                      lambda known: F.transform(numbers, lambda b: F.element_at(known, b))),
                 lambda dense: complete(x["bin"], dense))), "")

    filled = _let(bin_values(shingle_hashes(text, k), bins),
                  lambda x: F.struct(x["bin"].alias("bin"), F.transform(x["value"], low).alias("value")))
    # a lambda's argument is evaluated once, a plain expression at each use
    return _let(filled, pack)


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Estimated similarity of the shingle sets behind two fingerprints, from 0 to 1, chance matches taken off."""
    digits = bits // 4
    same = F.aggregate(F.sequence(F.lit(0), F.lit(bins - 1)), F.lit(0), lambda n, i: n + F.when(
        F.substring(a, i * digits + 1, F.lit(digits)) == F.substring(b, i * digits + 1, F.lit(digits)), 1).otherwise(0))
    chance = 1.0 / (1 << bits)
    return F.greatest(F.lit(0.0), (same / F.lit(float(bins)) - chance) / (1 - chance))


def followers(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id) over the distinct ids: the next one in ascending order, after the last the first; null first.

    Ids are dealt in ranges; within a range the next row is a window's, across ranges it is the least id of the next one.
    """
    ids = range_parts(ids.distinct(), [F.col("doc_id").asc_nulls_first()], "ids")
    within = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first())
    boxed = F.struct(F.col("doc_id").alias("id"))  # a struct tells a null id from none
    # one row per written range, a number the session sets
    heads = ids.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("id"))).alias("head"))
    by_part = Window.orderBy("part")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("part", F.coalesce(F.lead("head").over(by_part), F.first("head").over(whole)).alias("head"))
    return (ids.withColumn("following", F.lead(boxed).over(within)).join(F.broadcast(heads), "part")
            .select("doc_id", F.when(F.col("following").isNotNull(), F.col("following.id")).otherwise(F.col("head.id")).alias("next_id")))


def edited_fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = 5) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose second half is taken from the next document.

    Returns one row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The edited text has the last floor(n_chars / 2) code points replaced by the first as many, or all, of the
    next document's in ascending id; the first follows the last. One document follows itself.

    Null text is empty and has the fingerprint of the empty text. Rows of one id each have their own row; the next
    document of an id is the next different id, and among rows of that id the text that sorts first. Null ids come first. Empty
    tables give no rows. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = followers(rows.select("doc_id"))
    need = rows.groupBy("doc_id").agg(F.max(F.floor(F.length("text") / 2)).alias("need"))
    order = saved(order.join(need, order["doc_id"].eqNullSafe(need["doc_id"])).select(order["doc_id"], "next_id", "need"), "followers")
    prints = rows.select("*", F.unhex(fingerprint(F.col("text"), k)).alias("print"))

    heads = (prints.alias("r").join(order.alias("o"), F.col("r.doc_id").eqNullSafe(F.col("o.next_id")))
             .select(F.col("o.doc_id").alias("owner"), F.struct(
                 F.substring(F.col("r.text"), F.lit(1), F.col("o.need").cast("int")).alias("head"),
                 F.col("r.print").alias("print")).alias("head")))
    heads = heads.groupBy("owner").agg(F.min("head").alias("head"))
    half = F.floor(F.length("text") / 2).cast("int")
    own = prints.join(heads, F.col("doc_id").eqNullSafe(F.col("owner")))
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half),
                      F.substring(F.col("head.head"), F.lit(1), half))
    shown = lambda c: F.lower(F.hex(c))
    end = _let(F.struct(shown("print").alias("own"), fingerprint(edited, k).alias("edited"), shown("head.print").alias("next")),
               lambda x: F.struct(x["own"].alias("fingerprint"), x["edited"].alias("edited_fingerprint"),
                                  likeness(x["own"], x["edited"]).alias("near_edited"), likeness(x["own"], x["next"]).alias("near_next")))
    return own.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"),
                      F.explode(F.array(end)).alias("end")).select("doc_id", "n_chars", "edited_sha256", "end.*")
