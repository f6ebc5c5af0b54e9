"""Order MinHash fingerprints, in DataFrame functions only.

*Symbols* of a text are its runs of non-blank characters, cut every ``SYMBOL`` characters; a *k-mer* is
``k`` consecutive symbols (of a shorter text, all of them). Each k-mer is numbered by its occurrence in
the text, so repeats count, and the pair is hashed onto a ring of 64-bit numbers.

*Signature.* Its ``points`` entries come from as many hash functions, which are rotations of one: entry
b takes the ``size`` k-mers that follow the b-th of equally spaced points on the ring, that is the
minimal ones counted from there. Those keep their order in the text, and the ordered tuple is hashed to
32 bits. Two texts agree in an entry if they share its minimal k-mers and have them in one order, so
moved passages lower the likeness where plain MinHash sees none of it: the likeness of two texts is the
share of equal entries, and falls with their edit distance over symbols.

A hash and a place travel in one long (38 and 26 bits), so each step is a primitive sort or a pass over
an array of the row itself: no row is exploded into its k-mers and nothing is shuffled but whole texts,
once, to meet the next document.

*Next document.* Quantiles of the ids cut the descending order into ranges of a few dozen documents; a
range is a hash key, its last document is also sent to the range behind it, and a window inside the range
finds the next one. No task sorts more than a few ranges.

Defined results: a null text is the empty text; texts without a symbol have an empty fingerprint, and two
of them are alike (1.0), one of them and another text are not (0.0); rows equal in id and text are one
document, rows that share an id only follow each other, null counts as the largest id (see ``corpus``);
a single document is its own next; an empty table gives an empty table; other columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.llm.common import corpus, named, prepare

SYMBOL = 8
PLACE_BITS = 26
PLACES = (1 << PLACE_BITS) - 1
LAST_PLACE = (1 << PLACE_BITS - 1) - 1   # places from here on are one place
RANGE = 32                               # documents of a range of ids
RANGES = 1 << 16                         # at most, so that their bounds stay below a megabyte


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def below(ordered: Column, n: Column, bits: Column, bound: Column) -> Column:
    """How many of ``n`` ascending values are less than ``bound``: a binary search of ``bits`` steps."""
    return F.aggregate(
        F.transform(F.sequence(bits - 1, F.lit(0)), lambda s: F.call_function("shiftleft", F.lit(1), s)), F.lit(0),
        lambda at, step: F.when((at + step <= n) & (F.get(ordered, at + step - 1) < bound), at + step).otherwise(at))


def bits_of(n: Column) -> Column:
    """Steps that reach every number up to ``n``."""
    return F.greatest(F.length(F.bin(n.cast("long"))), F.lit(1))


def signature(text: Column, k: int = 2, size: int = 2, points: int = 64) -> Column:
    """Order MinHash entries (longs of 32 bits) of a text, null if it has no symbol."""
    marks = F.array(*[F.lit(-(1 << 63) + b * ((1 << 64) // points)) for b in range(points)])

    def placed(hashed: Column, place: Column) -> Column:
        return hashed.bitwiseAND(F.lit(~PLACES)).bitwiseOR(place)

    def kmers(symbols: Column) -> Column:
        """Hashes of the k-mers with their places, ascending: equal k-mers side by side, in text order."""
        return F.sort_array(F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(symbols) - k, F.lit(0))),
            lambda i: placed(F.xxhash64(*[F.get(symbols, i + j) for j in range(k)]), F.least(i, F.lit(LAST_PLACE)).cast("long"))))

    def high(x: Column) -> Column:
        return F.shiftright(x, PLACE_BITS)

    def numbered(mers: Column) -> Column:
        """Each k-mer hashed anew with the number of its occurrence, in ring order."""
        starts = F.filter(F.sequence(F.lit(0), F.size(mers) - 1),
                          lambda i: (i == 0) | (high(F.get(mers, i)) != high(F.get(mers, i - 1))))
        return let(starts, lambda st: F.sort_array(F.flatten(F.transform(st, lambda s, j: F.transform(
            F.sequence(F.lit(0), F.coalesce(F.get(st, j + 1), F.size(mers)) - s - 1),
            lambda r: placed(F.xxhash64(high(F.get(mers, s)), r), F.get(mers, s + r).bitwiseAND(F.lit(PLACES))))))))

    def entry(ring: Column, n: Column, bits: Column, mark: Column) -> Column:
        """The tuple that follows a mark, in text order: places are rotated to the front, sorted and cut off."""
        chosen = let(below(ring, n, bits, mark), lambda at: F.transform(
            F.sequence(F.lit(0), F.least(n, F.lit(size)) - 1), lambda j: F.get(ring, (at + j) % n)))
        turned = F.transform(chosen, lambda x: F.shiftleft(x, 64 - PLACE_BITS).bitwiseOR(F.shiftrightunsigned(x, PLACE_BITS)))
        hashes = F.transform(F.sort_array(turned), lambda x: x.bitwiseAND(F.lit((1 << 64 - PLACE_BITS) - 1)))
        return F.shiftrightunsigned(F.xxhash64(hashes), 32)

    def entries(ring: Column) -> Column:
        return let(bits_of(F.size(ring)), lambda bits: F.transform(marks, lambda m: entry(ring, F.size(ring), bits, m)))

    def of(symbols: Column) -> Column:
        return F.when(F.size(symbols) > 0, let(let(kmers(symbols), numbered), entries))

    return let(F.regexp_extract_all(text, F.lit(rf"\S{{1,{SYMBOL}}}"), F.lit(0)), of)


def printed(sig: Column) -> Column:
    """A signature as a string, eight hexadecimal digits an entry."""
    return F.coalesce(F.array_join(F.transform(sig, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries of two signatures."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.size(a)
    return F.when(a.isNull() & b.isNull(), F.lit(1.0)).when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(same)


def in_ranges(docs: DataFrame, n_docs: int) -> DataFrame:
    """``docs`` with ``bucket``, a range of doc_id, and ``guest``: the greatest document of each range
    comes once more, as a guest, to the range above it (that of the smallest ids follows the last)."""
    count = max(1, min(RANGES, n_docs // RANGE))
    shares = [i / count for i in range(1, count)] or [0.5]
    quantiles, last = docs.agg(F.percentile_approx("doc_id", shares, 10_000 + 4 * count), F.max("doc_id")).first()
    bounds = sorted({*(quantiles or ()), last} - {None})[-count:] or [0]
    ends = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    at = below(ends, F.lit(len(bounds)), F.lit(len(bounds).bit_length()), F.col("doc_id"))
    both = F.transform(F.array(at), lambda b: F.when(
        F.get(ends, b) == F.col("doc_id"),
        F.array(F.struct(b.alias("bucket"), F.lit(False).alias("guest")), F.struct(((b + 1) % len(bounds)).alias("bucket"), F.lit(True).alias("guest"))))
        .otherwise(F.array(F.struct(b.alias("bucket"), F.lit(False).alias("guest")))))
    return docs.select("*", F.inline(F.flatten(both)))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 2, size: int = 2,
                 points: int = 64, third: int = 3) -> DataFrame:
    """``(doc_id, n_chars, text, edited, fingerprint, edited_fingerprint, near_edited, near_next)``: each
    text with its fingerprint, and the text whose last ``1/third`` characters are replaced by the first as
    many of the next document in descending doc_id (after the last: the first)."""
    prepare(df.sparkSession)
    docs, n_docs, _, names = corpus(df, id_col, text_col)
    order = Window.partitionBy("bucket").orderBy("guest", F.desc("doc_id"))
    # The greatest document of a range is the one that follows the smallest of the range above it.
    rows = in_ranges(docs, n_docs).withColumn("next", F.lead("text").over(order))
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / third).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next", F.lit(1), cut)))
    rows = rows.withColumn("sig", signature(F.col("text"), k, size, points)).withColumn("next_sig", F.lead("sig").over(order))
    rows = rows.filter("not guest").withColumn("edited_sig", signature(F.col("edited"), k, size, points))
    return named(rows.select(
        "doc_id", "n_chars", "text", "edited", printed(F.col("sig")).alias("fingerprint"), printed(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next")), names)
