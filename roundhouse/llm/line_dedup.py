"""Near-duplicate lines by a deletion-neighbourhood join, in DataFrame functions alone.

The edit bound is one word: a line is a near copy if one word put in, taken out or replaced makes it another.
Every line emits the hashed key of each of its variants with one word deleted, and of itself. Lines with one
word replaced share a key at the same place; a line with one word more shares a key with the shorter line
itself. In a group of equal variants the earliest line answers for all, so no pairs are expanded. Every
candidate is then verified word by word, and the earliest line within the bound is kept.

Before variants are made, lines are pruned without loss: of two lines one edit apart, the shorter one of n words,
either the first or the last n // 2 words are the same. So a line emits the hashes of its first and last n // 2 and
(n - 1) // 2 words, and goes on only where another line has the same half; and since the edit is then in the other
half, only those words are deleted. Lines of fewer than `min_words` words (5 unless given) are copies only if equal:
one word of so few makes another text.

Earlier means a smaller (doc_id, line_no); a null doc_id is earliest. Lines are compared by their words,
parted by ASCII white space; lines without words (and null and empty texts) have no row. Repeated rows get
equal results; extra columns are passed over; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roundhouse.llm.common import few, stored

MIN_WORDS = 5
#: Words of a line from which a window makes its keys, not strings. The variants of such a line hold some 12 MB together.
LONG = 2048
#: Rows of a lookup that may be broadcast, about 100 bytes each; a larger one is joined by a shuffle.
SMALL = 500_000


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, line_no (from 0), line (its words, parted by single spaces), n_words and h1, h2 (128 bits of it), for every line that has words."""
    text = F.col("text")
    odd = F.contains(text, F.lit("\t")) | F.contains(text, F.lit("\r")) | F.contains(text, F.lit("\x0b")) | F.contains(text, F.lit("\x0c"))
    plain = F.when(odd, F.translate(text, "\t\r\x0b\x0c", "    ")).otherwise(text)
    lines = docs.select("doc_id", F.posexplode(F.split(plain, "\n")).alias("line_no", "line")).withColumn("line", F.trim("line")).where("line <> ''")
    line = F.when(F.contains("line", F.lit("  ")), F.regexp_replace("line", " +", " ")).otherwise(F.col("line"))
    lines = lines.select("doc_id", "line_no", line.alias("line"))
    n_words = F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit(" "), F.lit(""))) + 1
    return lines.withColumns({"n_words": n_words.cast("int"), "h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), F.col("line"))})


HEAD, FOOT = 0, 1


def halves(lines: DataFrame) -> DataFrame:
    """A row per half of each line: key, side and k, its number of words. Lines of odd length have one k, others two."""
    half = lambda side, k: f"struct(xxhash64({k}, {side}, substring_index(line, ' ', {'' if side == HEAD else '-'}({k}))) as key, {side} as side, {k} as k)"
    longer, shorter = [half(s, "n_words div 2") for s in (HEAD, FOOT)], [half(s, "(n_words - 1) div 2") for s in (HEAD, FOOT)]
    found = F.expr(f"case when n_words % 2 = 0 then array({', '.join(longer + shorter)}) else array({', '.join(longer)}) end")
    return lines.select("doc_id", "line_no", "h1", "h2", F.inline(found)).where("k > 0")


def candidates_of(lines: DataFrame) -> DataFrame:
    """The different lines that share a half with another: h1, h2, ord (the earliest place), line, n_words, and lo, hi: the least k of a shared head and foot."""
    rows = halves(lines)
    shared = rows.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("key")
    found = rows.join(few(stored(shared, "line-halves"), SMALL), "key", "left_semi")
    least = lambda side: F.min(F.when(F.col("side") == side, F.col("k")))
    found = found.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "line_no")).alias("ord"), least(HEAD).alias("lo"), least(FOOT).alias("hi"))
    found = few(stored(found, "line-flags"), SMALL)
    first = F.col("doc_id").eqNullSafe(F.col("ord.doc_id")) & (F.col("line_no") == F.col("ord.line_no"))
    return lines.join(found, ["h1", "h2"]).where(first).select("h1", "h2", "ord", "line", "n_words", "lo", "hi").distinct()


#: Whether the word at `pos` is deleted: it must lie outside of a shared half.
WANTED = "coalesce(pos >= lo, false) or coalesce(pos < n_words - hi, false)"


def variants(candidates: DataFrame) -> DataFrame:
    """(key, pos, h1, h2, ord): pos is the deleted word's place, -1 for the line itself.

    A line is hashed as a string without the word. For long lines that would grow with the square of their length: their keys are xors of hashes of
    (word, place in the variant), made by a window over the words. Lines of LONG words take both ways, so that they meet those of one word more and less.
    """
    return short_variants(candidates.where(F.col("n_words") <= LONG)).unionByName(long_variants(candidates.where(F.col("n_words") >= LONG)))


def short_variants(candidates: DataFrame) -> DataFrame:
    places = F.expr(f"filter(sequence(-1, n_words - 1), pos -> pos < 0 or {WANTED})")
    rows = candidates.withColumn("pos", F.explode(places))
    rest = "trim(concat(substring_index(line, ' ', pos), ' ', substring_index(line, ' ', pos + 1 - n_words)))"
    return rows.select(F.expr(f"case when pos < 0 then h1 else xxhash64({rest}) end").alias("key"), "pos", "h1", "h2", "ord")


def long_variants(candidates: DataFrame) -> DataFrame:
    line = Window.partitionBy("h1", "h2")
    so_far = line.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    after = line.orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    rows = candidates.select("h1", "h2", "ord", "n_words", "lo", "hi", F.posexplode(F.split("line", " ")).alias("pos", "word"))
    zero = F.lit(0).cast("long")
    rows = rows.withColumns({"here": F.xxhash64("word", "pos"), "moved": F.xxhash64("word", F.col("pos") - 1)})
    rows = rows.withColumn("before", F.coalesce(F.bit_xor("here").over(so_far), zero)).withColumn("later", F.coalesce(F.bit_xor("moved").over(after), zero))
    own = rows.where(WANTED).select(F.col("before").bitwiseXOR(F.col("later")).alias("key"), "pos", "h1", "h2", "ord")
    whole = rows.where("pos = n_words - 1").select(F.col("before").bitwiseXOR(F.col("here")).alias("key"), F.lit(-1).alias("pos"), "h1", "h2", "ord")
    return own.unionByName(whole)


def one_edit(a: Column, b: Column) -> Column:
    """Whether at most one word put in, taken out or replaced makes a into b."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False)).cast("int")
    first = F.when(differs == 0, F.least(F.size(a), F.size(b)) + 1).otherwise(differs)
    rest = lambda x, k: F.slice(x, first + k, F.greatest(F.size(x) - first - k + 1, F.lit(0)))
    same = F.size(a) == F.size(b)
    longer = F.size(a) == F.size(b) + 1
    shorter = F.size(a) + 1 == F.size(b)
    return F.when(same, rest(a, 1) == rest(b, 1)).when(longer, rest(a, 1) == rest(b, 0)).when(shorter, rest(a, 0) == rest(b, 1)).otherwise(False)


def dedup_lines(df: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, line_no, n_words, keep_doc, keep_line, kept of each line with words.

    keep_doc and keep_line name the earliest line within the bound; a line is kept if that is itself.
    """
    lines = stored(lines_of(df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), "lines")
    candidates = stored(candidates_of(lines.where(F.col("n_words") >= max(min_words, 2))), "line-candidates")

    made = stored(variants(candidates), "line-variants")
    keys = made.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("key")
    members = stored(made.join(few(stored(keys, "line-keys"), SMALL), "key", "left_semi"), "line-members")
    # the earliest line of a key answers for all: of those with the same deleted word for each of these, of all for the key's line itself
    by_place = stored(members.groupBy("key", "pos").agg(F.min(F.struct("ord", "h1", "h2")).alias("least")), "line-places")
    by_key = by_place.groupBy("key").agg(F.min("least").alias("of_all"), F.min(F.when(F.col("pos") < 0, F.col("least"))).alias("of_self"))
    # both are written before they are joined, so a key of very many lines can be split between tasks
    near = members.join(few(by_place, SMALL), ["key", "pos"]).join(few(stored(by_key, "line-leaders"), SMALL), "key")
    best = F.when(F.col("pos") < 0, F.col("of_all")).otherwise(F.least("least", "of_self"))
    pairs = near.withColumn("best", best).where("best.ord < ord").select("h1", "h2", F.col("best.h1").alias("k1"), F.col("best.h2").alias("k2"), F.col("best.ord").alias("keep")).distinct()
    pairs = stored(pairs, "line-pairs")

    words = candidates.select("h1", "h2", F.split("line", " ").alias("words"))
    other = words.select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), F.col("words").alias("other"))
    other = stored(other.join(few(stored(pairs.select("k1", "k2").distinct(), "line-kept"), SMALL), ["k1", "k2"], "left_semi"), "line-kept-words")
    both = pairs.join(words, ["h1", "h2"]).join(few(other, SMALL // 10), ["k1", "k2"])
    found = both.where(one_edit(F.col("words"), F.col("other"))).groupBy("h1", "h2").agg(F.min("keep").alias("near"))

    own = F.struct("doc_id", "line_no")
    copies = lines.groupBy("h1", "h2").agg(F.min(own).alias("first"), F.count("*").alias("n")).where("n > 1")
    # lines that are alone keep themselves; only the others are looked up
    answer = stored(copies.join(found, ["h1", "h2"], "full").select("h1", "h2", F.coalesce("near", "first").alias("keep")), "line-answers")
    out = lines.select("doc_id", "line_no", "n_words", "h1", "h2").join(few(answer, SMALL), ["h1", "h2"], "left").withColumn("keep", F.coalesce("keep", own))
    kept = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("line_no") == F.col("keep.line_no"))
    return out.select("doc_id", "line_no", "n_words", F.col("keep.doc_id").alias("keep_doc"), F.col("keep.line_no").alias("keep_line"), kept.alias("kept"))
