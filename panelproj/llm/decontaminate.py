"""Benchmark items in documents, also with other numbers, names and units in them.

Texts become templates: tokens are runs of letters or numbers, lower-cased; numbers, names and
units become typed placeholders, and what stood there is the slot's value. A name is a
capitalised word straight after a lower-case one, a number or a comma on the same line.

1. Template windows of ``window`` tokens are hashed. Benchmark windows with at least half of
   their tokens literal, and four, are the index (shorter items: the whole item is one window).
   Beside each of them its literal window, in lower case and without placeholders, is in the
   index too, and documents probe with both: an item in another case, or one whose first word
   follows a lower-case word, matches whatever its template has become.
2. Documents' windows meet the index in a hash join. The index side is broadcast if its counted
   rows are within ``most_broadcast``; beyond that both sides are shuffled.
3. On each alignment (document position minus item position) the slots of matched windows must
   be filled consistently: one item value always by the same document value, and two item
   values never by the same one. Alignments that fail are coincidences and do not count. A
   literal window is the item's own words, so it counts in any case.
4. A document is contaminated by an item if the matched windows on consistent alignments are at
   least ``coverage`` of the item's windows, or if one such alignment holds ``passage`` tokens in
   a row (consecutive matched windows), however long the item is.
5. An item none of whose windows has enough literal tokens is searched by its whole exact token
   sequence: all its literal windows on one alignment. Below four tokens the case must agree too.

Native functions only. Texts are read to hash their windows; only documents with hits are read
again for slot values. Rows are window hashes and positions, never texts.

Defined cases: null or empty texts and items match nothing; equal items each count; rows with equal id and text are judged
alike; extra columns are ignored; empty tables give no contamination.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelproj.llm.shared import checkpointed, free_name

# Spelled numbers and units that count as slots.
NUMBERS = "zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
UNITS = "mm cm m km inch inches foot feet yard yards mile miles g kg gram grams kilogram kilograms pound pounds ounce ounces ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years dollar dollars cent cents euro euros percent degree degrees watt watts volt volts".split()
LEAST_LITERAL = 4
MARK = "\u0001"
NAME = r"(?<=[\p{Ll}\p{N},]\x20)(?=\p{Lu}\p{Ll})"
TOKEN = MARK + r"?[\p{L}\p{M}]++|[0-9]++(?:[.,][0-9]++)*+"


def tokens(text: Column) -> Column:
    """Letter runs and numbers of a text in order; names begin with a mark."""
    return F.regexp_extract_all(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), NAME, MARK), F.lit(TOKEN), F.lit(0))


def template(token: Column) -> Column:
    low = F.lower(token)
    return F.when(F.substring(token, 1, 1) == MARK, "<name>").when(token.rlike("^[0-9]") | low.isin(NUMBERS), "<num>").when(low.isin(UNITS), "<unit>").otherwise(low)


def unmarked(token: Column) -> Column:
    """A token without the mark of a name."""
    return F.when(F.startswith(token, F.lit(MARK)), F.substring(token, 2, 2**31 - 1)).otherwise(token)


def literal(token: Column) -> Column:
    """A token in lower case, without the mark of a name."""
    return F.lower(unmarked(token))


def is_slot(word: Column) -> Column:
    return F.substring(word, 1, 1) == "<"


def _windows(hashes: Column, window: int) -> Column:
    """A hash for each full window of token hashes."""
    starts = F.sequence(F.lit(0), F.size(hashes) - window)
    return F.when(F.size(hashes) >= window, F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)])))


def benchmark_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """window_hash, verbatim, item_id, item_pos, length (tokens in the window) of each literal window, and of the typed one if it has slots and enough literal tokens.

    counted: a window with enough literal tokens, or any of an item without such windows (whole); n_windows: how many the item has.
    """
    words = benchmark.select("item_id", tokens(F.col("text")).alias("t")).where(F.size("t") > 0)
    plain = F.when(F.size("t") < LEAST_LITERAL, F.transform("t", unmarked)).otherwise(F.transform("t", literal))
    words = words.select("item_id", F.transform("t", template).alias("words"), plain.alias("plain"))
    size = F.least(F.size("words"), F.lit(window))
    rows = words.select("item_id", "words", "plain", size.alias("length"), F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("item_pos"))
    part = lambda c: F.slice(c, F.col("item_pos") + 1, F.col("length"))
    n_literal = F.size(F.filter(part("words"), lambda w: ~is_slot(w)))
    rows = rows.withColumn("rich", (n_literal * 2 >= F.col("length")) & (n_literal >= LEAST_LITERAL))

    def window_hash(c: str) -> Column:
        hashed = F.transform(part(c), lambda w: F.xxhash64(w))
        return F.when(F.col("length") == window, F.xxhash64(*[F.get(hashed, F.lit(k)) for k in range(window)])).otherwise(F.xxhash64(hashed))

    n = rows.groupBy("item_id").agg(F.count_if("rich").alias("n_rich"), F.count(F.lit(1)).alias("n_all"))
    n = n.select("item_id", (F.col("n_rich") == 0).alias("whole"), F.when(F.col("n_rich") == 0, F.col("n_all")).otherwise(F.col("n_rich")).alias("n_windows"))
    plain = rows.select("item_id", "item_pos", "length", "rich", window_hash("plain").alias("window_hash"), F.lit(True).alias("verbatim"))
    typed = rows.where(F.col("rich") & (n_literal < F.col("length"))).select("item_id", "item_pos", "length", "rich", window_hash("words").alias("window_hash"), F.lit(False).alias("verbatim"))
    return plain.unionByName(typed).join(n, "item_id").withColumn("counted", F.col("rich") | F.col("whole")).drop("rich")


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 8, coverage: float = 0.5, passage: int = 13, most_broadcast: int = 200_000) -> DataFrame:
    """row_key, item_id and coverage of every document and item that contaminates it. row_key is a hash of the document's id and text."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    index = checkpointed(benchmark_windows(items, window))
    held = index.agg(F.count(F.lit(1)).alias("n"), F.min("length").alias("short")).first()
    side = F.broadcast(index) if held["n"] <= most_broadcast else index
    texts = docs.select(row_key().alias("row_key"), "text")
    hashed = texts.select("row_key", tokens(F.col("text")).alias("t"))
    hashed = hashed.select("row_key", "t", F.transform("t", lambda t: F.xxhash64(template(t))).alias("h"), F.transform("t", lambda t: F.xxhash64(literal(t))).alias("p"))
    found = _probes(hashed, lambda h: _windows(h, window))
    hits = found.join(side.where(F.col("length") == window), "window_hash")
    lengths = [r["length"] for r in index.where(F.col("length") < window).select("length").distinct().collect()] if held["n"] and held["short"] < window else []
    for length in sorted(lengths):  # at most window - 1 of them
        cased = hashed.select("row_key", F.transform("t", lambda t: F.xxhash64(unmarked(t))).alias("h")).withColumn("p", F.col("h"))
        short = _probes(cased if length < LEAST_LITERAL else hashed, lambda h, n=length: _short(h, n))
        hits = hits.unionByName(short.join(side.where(F.col("length") == length), "window_hash"))
    hits = checkpointed(hits.select("row_key", "pos", "item_id", "item_pos", "length", "n_windows", "verbatim", "counted", "whole").distinct())

    run = F.when(F.col("whole"), F.col("n_windows")).otherwise(max(1, passage - window + 1)).cast("int")
    counted = F.countDistinct(F.when(F.col("counted"), F.col("item_pos")))
    enough = hits.groupBy("row_key", "item_id", "n_windows", "whole").agg(counted.alias("n"), F.countDistinct("item_pos").alias("n_any"))
    enough = enough.where((~F.col("whole") & (F.col("n") >= F.col("n_windows") * coverage)) | (F.col("n_any") >= run))
    likely = hits.join(enough.select("row_key", "item_id"), ["row_key", "item_id"], "left_semi").withColumn("shift", F.col("pos") - F.col("item_pos"))
    typed = likely.where(~F.col("verbatim"))
    same = likely.where("verbatim")
    failed = _inconsistent(likely, texts, items)
    sound = typed.join(failed, ["row_key", "item_id", "shift"], "left_anti").unionByName(same)
    share = sound.groupBy("row_key", "item_id", "n_windows", "whole").agg((counted / F.col("n_windows")).alias("coverage"))
    aligned = sound.groupBy("row_key", "item_id", "shift", "n_windows", "whole").agg(F.array_sort(F.collect_set("item_pos")).alias("at"))
    in_a_row = F.exists(F.sequence(F.lit(0), F.size("at") - run), lambda i: F.get("at", i + run - 1) - F.get("at", i) == run - 1)
    held = aligned.where(F.when(F.size("at") >= run, in_a_row)).select("row_key", "item_id").distinct().withColumn("held", F.lit(True))
    share = share.join(held, ["row_key", "item_id"], "left").where((~F.col("whole") & (F.col("coverage") >= coverage)) | F.col("held"))
    return checkpointed(share.select("row_key", "item_id", "coverage"))


def _probes(hashed: DataFrame, windows) -> DataFrame:
    """row_key, pos and window_hash of every typed window, and of every literal one that differs from it."""
    both = F.transform(F.arrays_zip(windows(F.col("h")).alias("typed"), windows(F.col("p")).alias("plain")), lambda z: F.array_distinct(F.array(z["typed"], z["plain"])))
    at = hashed.select("row_key", F.posexplode(both).alias("pos", "some"))
    return at.select("row_key", "pos", F.explode("some").alias("window_hash"))


def _short(h: Column, length: int) -> Column:
    return F.when(F.size(h) >= length, F.transform(F.sequence(F.lit(1), F.size(h) - length + 1), lambda i: F.xxhash64(F.slice(h, i, length))))


def _inconsistent(likely: DataFrame, texts: DataFrame, items: DataFrame) -> DataFrame:
    """row_key, item_id and shift of the alignments whose slots are not filled one to one."""
    tokens_of = lambda df, key, at: df.select(key, F.posexplode(tokens(F.col("text"))).alias(at, "token"))
    item_slots = tokens_of(items, "item_id", "item_at").where(is_slot(template(F.col("token")))).select("item_id", "item_at", literal(F.col("token")).alias("item_value"))
    aligned = likely.select("row_key", "item_id", "shift", F.explode(F.sequence("item_pos", F.col("item_pos") + F.col("length") - 1)).alias("item_at")).distinct()
    aligned = aligned.join(item_slots, ["item_id", "item_at"]).withColumn("doc_at", F.col("item_at") + F.col("shift"))
    keys = aligned.select("row_key").distinct()
    doc_tokens = tokens_of(texts.join(keys, "row_key", "left_semi").dropDuplicates(["row_key"]), "row_key", "doc_at")
    doc_slots = doc_tokens.select("row_key", "doc_at", literal(F.col("token")).alias("doc_value"))  # a literal window's slots need not look like slots in the document
    filled = aligned.join(doc_slots, ["row_key", "doc_at"]).select("row_key", "item_id", "shift", "item_value", "doc_value").distinct()
    one = filled.groupBy("row_key", "item_id", "shift", "item_value").agg(F.count(F.lit(1)).alias("n"))
    two = filled.groupBy("row_key", "item_id", "shift", "doc_value").agg(F.count(F.lit(1)).alias("n"))
    return one.where("n > 1").select("row_key", "item_id", "shift").unionByName(two.where("n > 1").select("row_key", "item_id", "shift")).distinct()


def row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))


def contamination(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """doc_id, contaminated, n_items and item_id (the smallest item found) of every document."""
    found = matches(docs, benchmark, **parameters).groupBy("row_key").agg(F.count(F.lit(1)).alias("n_items"), F.min("item_id").alias("item_id"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"))
    joined = keyed.join(found, "row_key", "left")
    return joined.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"), "item_id")


def clean_documents(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    own, other = free_name("own_key", docs), free_name("other_key", docs)
    found = matches(docs, benchmark, **parameters).select(F.col("row_key").alias(other)).distinct()
    return docs.withColumn(own, row_key()).join(found, F.col(own) == F.col(other), "left_anti").drop(own)
