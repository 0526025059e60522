"""Removal of lines that nearly repeat an earlier line, by an exact set-similarity join.

A line is the set of its five-word shingles (a shorter line: its words as one), and two lines
match from a Jaccard similarity of ``similarity`` on. The join:

* tokens are ordered by rarity: shingles are counted over all lines, in a table of fixed size by
  hash (any common order keeps the join exact, a good one keeps it small), so a passage that many lines share comes last in all of them;
* prefix filter: two matching lines share one of their n - ceil(t n) + 1 first tokens;
* length filter (t n <= m) and positional filter (from the shared positions on, enough tokens
  must be left to reach the overlap that t asks for);
* parity filter: sets that may match differ in few tokens, hence in few of 64 parities of
  token classes; in the second pass, where 64 say little of a larger set, in few of 512 more;
* verification of the Jaccard similarity on the lines' full sets.

Equal lines are one line of the join, standing where it occurs first; later occurrences go. For
the rest there are two passes, so that a large group of near copies does not become all its
pairs: first each line is compared with the earliest line of each token it shares, then the
lines that are left with all earlier lines, removed ones too. So exactly the lines with an
earlier match go, whatever the order of the tokens.

Order is by doc_id (null last) and the line's number, ties by hashes of the document and the line. Lines without a word stay.
Native functions only. Lines are hashes; only texts that hold a line of a candidate pair move to
compare it, and only texts that lose a line move for the result. The others stay where they are
read: what tells them is a bitmap of ids.

Defined cases: null text stays null and has no lines; equal rows are one place for the order, so
both keep the same lines; extra columns are kept by ``without_repeated_lines``; an empty table
gives an empty result.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelproj.llm.shared import free_name, with_membership, written

SHINGLE = 5
COUNT_BITS = 16
LARGE, MORE_PARITIES = 48, 8  # tokens of a set from which the second pass has so many more words of 64 parities


def row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def lines_of(docs: DataFrame) -> DataFrame:
    """place (null id, id, row key), line_no and line of every line of every document."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"))
    return docs.select(place.alias("place"), F.posexplode(F.split(F.col("text").cast("string"), "\n", -1)).alias("line_no", "line"))


def shingles(line: Column) -> Column:
    """Hashes of the five-word shingles of a line that has a word."""
    blank = lambda c: F.contains(line, F.lit(c))
    odd = blank("\t") | blank("\r") | blank("\x0b") | blank("\x0c") | blank("  ") | F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    words = F.split(F.when(odd, F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))).otherwise(line), " ")
    starts = lambda w: F.sequence(F.lit(0), F.size(w) - SHINGLE)
    many = lambda w: F.transform(starts(w), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))
    # a one-element array lets the words be split once
    return F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) >= SHINGLE, many(w)).otherwise(F.array(F.xxhash64(w)))), F.lit(0))


def frequencies(lines: DataFrame) -> Column:
    """The magnitude of shingles' counts by hash bucket, as a constant array of 64 KB. Every shingle of every line counts."""
    bucket = F.col("s").bitwiseAND((1 << COUNT_BITS) - 1).alias("bucket")
    counted = lines.select(F.explode(shingles(F.col("line"))).alias("s")).groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
    magnitude = [0] * (1 << COUNT_BITS)
    for row in counted.select("bucket", F.floor(F.log2(F.col("n") + 1) * 2).alias("m")).collect():
        magnitude[row["bucket"]] = min(row["m"], 100)
    return F.from_json(F.lit(str(magnitude).replace(" ", "")), "array<tinyint>")


def by_rarity(tokens: Column, magnitude: Column) -> Column:
    """Distinct tokens as longs that sort by the magnitude of their count (in the highest byte), then by hash."""
    rank = lambda t: F.shiftleft(F.coalesce(F.get(magnitude, t.bitwiseAND((1 << COUNT_BITS) - 1).cast("int")), F.lit(0).cast("tinyint")).cast("long"), 56)
    return F.sort_array(F.array_distinct(F.transform(tokens, lambda t: rank(t).bitwiseOR(F.shiftrightunsigned(t, 8)))))


def parities(tokens: Column) -> Column:
    """64 bits: whether a set has an odd number of tokens in each of 64 classes. Two sets differ in as many tokens as bits at least."""
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda a, t: a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(63).cast("int"))))


def more_parities(tokens: Column) -> Column:
    """A struct of so many words of parities, each of the tokens of one class."""

    def word(of: Column, k: int) -> Column:
        return parities(F.filter(of, lambda t: F.shiftright(t, 6).bitwiseAND(MORE_PARITIES - 1) == k))

    return F.get(F.transform(F.array(tokens), lambda of: F.struct(*[word(of, k).alias(f"w{k}") for k in range(MORE_PARITIES)])), F.lit(0))


def _least_overlap(n: Column, m: Column, similarity: float) -> Column:
    return F.ceil((n + m) * (similarity / (1 + similarity)) - 1e-9)


def line_verdicts(docs: DataFrame, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Two tables: the first place of each distinct line (line_hash, place, line_no), and the hashes of lines that nearly repeat an earlier one."""
    # The filter looks at the line and not at its tokens, which would then be made twice.
    lines = lines_of(docs).where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    magnitude = frequencies(lines)
    hashed = lines.select("place", "line_no", F.xxhash64("line").alias("line_hash"), by_rarity(shingles(F.col("line")), magnitude).alias("tokens"))
    n = F.size("tokens")
    prefix = F.slice("tokens", 1, n - F.ceil(n * similarity - 1e-9).cast("int") + 1)
    # the line's place, size and parities go with its first token only
    hashed = hashed.withColumn("parities", parities(F.col("tokens")))
    rows = hashed.select("line_hash", F.struct("place", "line_no", "parities", n.alias("n")).alias("at"), F.posexplode(prefix).alias("pos", "token"))
    # one long: 56 bits of the token, and its position in the last byte (a position above 255 counts as 255, by which the positional filter lets more through)
    packed = F.col("token").bitwiseAND(~255).bitwiseOR(F.least("pos", F.lit(255)).cast("long"))
    rows = rows.select(packed.alias("packed"), "line_hash", F.when(F.col("pos") == 0, F.col("at")).alias("at"))
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    token = F.shiftright("packed", 8)
    met = rows.repartition(n_parts, token).groupBy(token.alias("token"), "line_hash").agg(F.min("packed").alias("packed"), F.min("at").alias("at"))
    met = met.withColumn("lines", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("lines > 1 or at IS NOT NULL")
    met = written(met.select(F.when(F.col("lines") > 1, F.col("packed")).alias("packed"), "line_hash", "at"))

    first = met.where("at IS NOT NULL").select("line_hash", "at.*")
    tokens = met.where("packed IS NOT NULL").select(token.alias("token"), F.col("packed").bitwiseAND(255).cast("int").alias("pos"), "line_hash").join(first, "line_hash")
    return first.select("line_hash", "place", "line_no"), _near(docs, written(tokens), similarity)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """line_hash and set of shingles of lines; wanted: line_hash, id, row_key and line_no. Only texts that hold one of them move."""
    by_row = written(wanted.groupBy("row_key").agg(F.first("id").alias("doc_id"), F.collect_list(F.struct("line_hash", "line_no")).alias("some")))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    texts = with_membership(texts, by_row, "asked").where("asked OR doc_id IS NULL").select(row_key().alias("row_key"), "text")
    found = texts.join(by_row.select("row_key", "some"), "row_key")
    sets = found.select(F.split("text", "\n", -1).alias("all"), F.explode("some").alias("one"))
    return sets.select("one.line_hash", F.array_distinct(shingles(F.get("all", F.col("one.line_no")))).alias("set"))


def _near(docs: DataFrame, tokens: DataFrame, similarity: float) -> DataFrame:
    """line_hash of the lines to remove; tokens: token, pos, line_hash, place, line_no, parities and n of tokens that several lines share."""
    tokens = tokens.select("token", "line_hash", "n", "pos", "parities", F.coalesce("place.doc_id", F.lit(2**63 - 1)).alias("id"), F.col("place.row_key").alias("row_key"), "line_no")
    about = {"line_hash": "{0}", "n": "n_{0}", "pos": "pos_{0}", "parities": "parities_{0}", "id": "id_{0}", "row_key": "row_key_{0}", "line_no": "no_{0}"}

    def matched(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The later lines x of verified pairs (x, y). Each set moves once, to the pairs that it is in."""
        ends = pairs.select("x", "y", F.explode(F.array("x", "y")).alias("line_hash"))
        set_of = lambda end: F.first(F.when(F.col("line_hash") == F.col(end), F.col("set")), ignorenulls=True).alias(f"{end}_set")
        both = sets.join(ends.hint("merge"), "line_hash").groupBy("x", "y").agg(set_of("x"), set_of("y"))
        overlap = F.size(F.array_intersect("x_set", "y_set"))
        return written(both.where(overlap >= (F.size("x_set") + F.size("y_set") - overlap) * similarity - 1e-9).select("x").distinct())

    differing = lambda field: F.bit_count(F.col(field.format("x")).bitwiseXOR(F.col(field.format("y"))))
    named = lambda of, by="": [F.col(f"{by}{c}").alias(to.format(of)) for c, to in about.items()]

    def candidates(met: DataFrame, also: Callable[[Column], Column] | None = None) -> DataFrame:
        """The pairs that pass the filters, of pairs that share a token; also: a further filter, given how many tokens a pair may differ in."""
        before = F.struct("id_y", "no_y", "y") < F.struct("id_x", "no_x", "x")
        lengths = (F.col("n_x") >= F.col("n_y") * similarity) & (F.col("n_y") >= F.col("n_x") * similarity)
        reach = F.least("pos_x", "pos_y") + 1 + F.least(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y")) - 1
        least = _least_overlap(F.col("n_x"), F.col("n_y"), similarity)
        most = F.col("n_x") + F.col("n_y") - 2 * least
        alike = differing("parities_{}") <= most
        both = before & lengths & (reach >= least) & alike
        pairs = met.where(both if also is None else both & also(most))
        return written(pairs.select("x", "id_x", "row_key_x", "no_x", "y", "id_y", "row_key_y", "no_y").distinct())

    def more_alike(most: Column) -> Column:
        """Null, which a set that is not large has, says nothing."""
        return F.coalesce(sum((differing(f"more_{{}}.w{k}") for k in range(MORE_PARITIES)), F.lit(0)) <= most, F.lit(True))

    place, group = F.struct("id", "line_no", "line_hash"), Window.partitionBy("token")
    head = F.min(F.struct("id", "line_no", "line_hash", "n", "pos", "parities", "row_key")).over(group)
    pairs = candidates(tokens.withColumn("h", head).select(*named("x"), *named("y", "h.")))
    ends = [pairs.select(F.col(of).alias("line_hash"), F.col(f"id_{of}").alias("id"), F.col(f"row_key_{of}").alias("row_key"), F.col(f"no_{of}").alias("line_no")) for of in "xy"]
    gone = matched(pairs, _sets(docs, ends[0].unionByName(ends[1]).distinct()))

    # lines that are left ask the others of a token, unless they are its earliest; sets are made once, for the parities and to verify
    told = tokens.join(gone.select(F.col("x").alias("line_hash"), F.lit(True).alias("is_gone")), "line_hash", "left")
    told = told.withColumn("asks", F.col("is_gone").isNull() & (place > F.min(place).over(group)))
    meeting = written(told.withColumn("asked", F.max("asks").over(group)).where("asked").drop("asked", "is_gone"))
    sets = written(_sets(docs, meeting.select("line_hash", "id", "row_key", "line_no").distinct()))
    # equal rows of a document give a line's set more than once
    more = sets.where(F.size("set") >= LARGE).select("line_hash", more_parities(F.col("set")).alias("more")).groupBy("line_hash").agg(F.first("more").alias("more"))
    meeting = written(meeting.join(more.hint("merge"), "line_hash", "left"))
    met = meeting.where("asks").select("token", *named("x"), F.col("more").alias("more_x")).join(meeting.select("token", *named("y"), F.col("more").alias("more_y")), "token")
    return gone.unionByName(matched(candidates(met, more_alike), sets)).select(F.col("x").alias("line_hash"))


def removed_lines(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """key_of_gone (a row key), its doc_id and gone_lines (line numbers) of the documents that lose lines."""
    first, near = line_verdicts(docs, similarity)
    verdict = first.select("line_hash", F.struct("place", "line_no").alias("first_at")).join(near.withColumn("near", F.lit(True)), "line_hash", "left")
    lines = lines_of(docs).select(F.struct("place", "line_no").alias("at"), F.xxhash64("line").alias("line_hash"))
    gone = lines.join(verdict, "line_hash").where("near or at <> first_at")
    return written(gone.groupBy(F.col("at.place.row_key").alias("key_of_gone")).agg(F.min("at.place.doc_id").alias("doc_id"), F.collect_set("at.line_no").alias("gone_lines")))


def _with_gone(docs: DataFrame, gone: DataFrame, numbers: str) -> DataFrame:
    """The documents with the numbers of the lines that they lose (null: none). Only documents that lose lines, and those without an id, move."""
    own, other, loses = (free_name(stem, docs) for stem in ("own_key", "other_key", "loses_lines"))
    told = with_membership(docs, gone, loses)
    moved = told.where(F.col(loses) | F.col("doc_id").isNull()).withColumn(own, row_key())
    # what is lost grows with the documents, so it is never sent to all tasks
    lost = gone.select(F.col("key_of_gone").alias(other), F.col("gone_lines").alias(numbers)).hint("merge")
    moved = moved.join(lost, F.col(own) == F.col(other), "left")
    kept = told.where(~F.col(loses) & F.col("doc_id").isNotNull()).withColumn(numbers, F.lit(None).cast("array<int>"))
    return moved.select(*docs.columns, numbers).unionAll(kept.select(*docs.columns, numbers))


def _kept(text: Column, gone: Column) -> Column:
    """The text without the numbered lines."""
    all_lines = F.split(text, "\n", -1)
    keep = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), gone)
    return F.when(gone.isNull() | text.isNull(), text).otherwise(F.array_join(F.transform(keep, lambda i: F.get(all_lines, i)), "\n"))


def without_repeated_lines(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The documents with all their columns and the repeated lines taken out of the text. A document may lose all its lines; it stays, with an empty text."""
    numbers = free_name("line_numbers", docs)
    joined = _with_gone(docs, removed_lines(docs, similarity), numbers)
    return joined.withColumn("text", _kept(F.col("text").cast("string"), F.col(numbers))).select(*docs.columns)


def line_dedup(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """doc_id, n_lines, n_removed and kept_sha256 (of the remaining text) of every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = _with_gone(texts, removed_lines(texts, similarity), "gone_lines")
    text = F.coalesce("text", F.lit(""))
    return joined.select(
        "doc_id",
        F.size(F.split(text, "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone_lines"), F.lit(0)).cast("long").alias("n_removed"),
        F.sha2(_kept(text, F.col("gone_lines")), 256).alias("kept_sha256"),
    )
