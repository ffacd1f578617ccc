"""Document fingerprints by order MinHash, with DataFrame functions only.

The k-mers of a text are its runs of five words (a word is a run of characters other than
``[\\x20\\x09-\\x0D]``; one to four words are one k-mer), numbered by occurrence. They are placed on a ring by hash, and the occurrences of a k-mer in
text order. Entry m of the fingerprint looks at the ring from its own mark on: it takes the first
``TUPLE`` occurrence-numbered k-mers, puts them back into the order in which they stand in the
text, and hashes that tuple. Turning one ring stands for many hash functions. Two texts agree in
an entry when the same minimal k-mers occur in the same order, so moving passages counts as a
change, and the share of equal entries (``likeness``) falls with the edit distance.

A text is handled whole in its row: split, hashed, sorted (k-mer and position packed into one
number) and cut at the marks. No k-mer is shuffled, and hot texts or k-mers meet nowhere.

For the neighbours (``with_neighbours``), documents are put in descending order of id through keys and lengths
alone: sorted by range, and linked over the ends of the sorted pieces. Then each document sends the
piece of text that its predecessor asks for, and its fingerprint.

Null texts are empty ones; a text without words has a fingerprint like any other, equal only to
those of texts without words. Documents without an id come last; those with one id follow each other by the digest of id and
text, and rows that repeat both are one document: each gets the same result. An empty table gives
an empty result. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import stored

KMER_WORDS = 5
ENTRIES = 64
TUPLE = 2
#: Marks of the entries on the ring of signed 64-bit numbers.
MARKS = [-(2**63) + m * (2**64 // ENTRIES) for m in range(ENTRIES)]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, "[ \\t-\\r]+"), "")


def _kmers(words: Column, k: int = KMER_WORDS) -> Column:
    """Hash of the words from each position on; one k-mer for a text of fewer than ``k`` words."""

    def of(hashes: Column) -> Column:
        # ``get`` gives null beyond the end, which the hash passes over.
        run = F.transform(hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + j) for j in range(1, k)]))
        return F.slice(run, F.lit(1), F.greatest(F.size(hashes) - (k - 1), F.least(F.size(hashes), F.lit(1))))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), of)


def _entry(kmers: Column, places: Column) -> Column:
    """Hash of the k-mers at these places (in text order), with their occurrence numbers.

    Equal k-mers lie on the ring in text order and a tuple begins with the first of them, so what
    comes before one in the tuple are all its earlier occurrences.
    """

    def numbered(p: Column, t: Column) -> Column:
        kmer = F.get(kmers, p - 1)
        so_far = F.filter(F.slice(places, F.lit(1), t + 1), lambda q: F.get(kmers, q - 1) == kmer)
        return F.xxhash64(kmer, F.size(so_far))

    whole = F.aggregate(F.transform(places, numbered), F.lit(0).cast("bigint"), lambda h, x: F.xxhash64(h, x))
    # The low 32 bits, as a signed number.
    return (whole.bitwiseAND(F.lit(2**32 - 1).cast("bigint")) - 2**31).cast("int")


def _signature(kmers: Column) -> Column:
    n = F.size(kmers)
    zero = F.lit(0).cast("bigint")
    marks = F.array(*[F.lit(m).cast("bigint") for m in MARKS])

    def of(mask: Column) -> Column:
        # ``coalesce`` says that there are no nulls: such arrays are sorted as plain numbers.
        packed = F.transform(kmers, lambda v, i: F.coalesce(v.bitwiseAND(mask).bitwiseOR((i + 1).cast("bigint")), zero))
        low = F.bitwise_not(mask)
        ring = F.sort_array(F.concat(packed, marks))
        places = F.transform(ring, lambda e: F.coalesce(e.bitwiseAND(low).cast("int"), F.lit(0)))
        return _let(places, read)

    def read(places: Column) -> Column:
        at = F.array_remove(F.transform(places, lambda p, i: F.when(p == 0, i).otherwise(F.lit(-1))), -1)
        real = F.array_remove(places, 0)
        # Once around, and on to the first ones again.
        around = F.concat(real, F.slice(real, 1, TUPLE))
        take = F.least(n, F.lit(TUPLE))
        return _let(
            around,
            lambda a: F.transform(
                at,
                lambda i, m: _let(F.sort_array(F.slice(a, i - m + 1, take)), lambda places: _entry(kmers, places)),
            ),
        )

    # Low bits hold the place (from 1), the others the hash; marks have place 0.
    bits = F.length(F.bin(n))
    return _let(F.call_function("shiftleft", F.lit(-1).cast("bigint"), bits), of)


def signature(text: Column) -> Column:
    """``ENTRIES`` hashes of a text (not null)."""
    return _let(_kmers(_words(text)), _signature)


def fingerprint_text(sign: Column) -> Column:
    """The signature as a string: eight hexadecimal digits an entry."""
    return F.array_join(F.transform(sign, lambda h: F.lower(F.lpad(F.hex(h.cast("bigint") + 2**31), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of entries in which two signatures agree."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(ENTRIES))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` for every row of ``docs``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), fingerprint_text(signature(text)).alias("fingerprint"))


def _predecessors(keys: DataFrame) -> DataFrame:
    """``key, before``: for each of ``doc_id, key, n_chars`` the row before it in descending order, around the end."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("key")]
    piece = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    piece = piece.select(
        "key",
        F.struct("doc_id", "key", "n_chars").alias("row"),
        F.spark_partition_id().alias("piece"),
        F.monotonically_increasing_id().alias("nr"),
    )
    piece = stored(piece, "order-keys")
    inside = Window.partitionBy("piece").orderBy("nr")
    linked = piece.select("piece", "key", F.lag("row").over(inside).alias("before"))
    # The last row of each piece goes before the first row of the next, and the very last before the very first.
    ends = piece.groupBy("piece").agg(F.max_by("row", "nr").alias("last"))
    over = Window.orderBy("piece")
    around = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("piece", F.coalesce(F.lag("last").over(over), F.last("last").over(around)).alias("last"))
    return linked.join(ends, "piece").select("key", F.coalesce("before", "last").alias("before"))


def with_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part: int = 3) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like these and the next document it is.

    The edit puts the first code points of the next document (descending id, then the first again) in
    place of the last n / ``part`` ones. Columns: ``doc_id, n_chars, edited_sha256, signature, edited_signature,
    near_edited, near_next``.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("text"))
    rows = rows.withColumn("key", F.sha2(name.cast("binary"), 256))
    keys = rows.select("doc_id", "key", F.length("text").cast("bigint").alias("n_chars")).distinct()
    order = stored(_predecessors(keys), "order-links")

    # Each document gives its predecessor as many code points as are replaced there. Both joins read the
    # same shuffle of the texts.
    texts = rows.select("key", "text")
    asked = F.floor(F.col("before.n_chars") / part).cast("int")
    heads = texts.join(order, "key").select("before.*", F.substring("text", F.lit(1), asked).alias("head"))
    heads = heads.dropDuplicates(["key"])
    kept = F.length("text") - F.floor(F.length("text") / part).cast("int")
    both = texts.join(heads, "key").withColumn("edited", F.concat(F.substring("text", F.lit(1), kept), F.col("head")))
    signed = both.select(
        "doc_id",
        "key",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        signature(F.col("text")).alias("signature"),
        signature(F.col("edited")).alias("edited_signature"),
    )
    signed = stored(signed, "order-signed")
    following = signed.select("key", "signature").join(order, "key")
    following = following.select("before.key", F.col("signature").alias("_next")).dropDuplicates(["key"])
    return signed.join(following, "key").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "signature",
        "edited_signature",
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("_next")).alias("near_next"),
    )
