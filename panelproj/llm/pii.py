"""Personal data in texts: four base detectors, and terms that give a protected entity away.

Base spans (email, ip, card, phone) name protected entities. Sanitisation must also look at the
words with them: a term that occurs in the corpus almost only in one entity's documents reveals it
even when the entity itself is masked. How strongly, is measured by corpus co-occurrence: with
N documents, n(e) holding entity e, n(t) holding term t and n(t, e) holding both,

    PMI(t; e) = log(N n(t, e) / (n(t) n(e))),   IC(e) = log(N / n(e)),

and the disclosure PMI / IC = 1 + log(n(t, e) / n(t)) / IC is 1 for a term that occurs nowhere
else. Terms are reported wherever they stand in a document with the entity: from ``generalise`` on as kind
``general`` (to be replaced by a broader word), from ``remove`` on as ``term`` (to be removed).

Every pair that occurs together is estimated, from one document on. Small counts are shrunk: the
share q = n(t, e) / n(t) moves towards the base rate p = n(e) / N by the weight
w = c / (c + ``doubt``), where c = exp(-n(t) KL(q || p)) bounds (Chernoff) the chance that
independent ones meet as often. One document in 26 leaves a doubt of 0.43, one in 10,000 of 0.002.

Counts cover every document: all words of all texts are counted by term with map-side
combination, so a frequent word is one row per task. Entities and terms are never collected. Since
n(t, e) <= n(e), a term in more than n(e) / p^(1 - ``generalise``) documents cannot disclose e; such
pairs are left out before they are counted, which changes no result.

Native functions only. Context: the whole text, whole words of any length outside base spans but
for the English function words of up to three letters in FUNCTION_WORDS, which name nobody.
Defined cases: a null text is empty; equal rows are scanned alike, each with its own
output row; extra columns are ignored; an empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelproj.llm import spans
from panelproj.llm.shared import free_name, written

KINDS = ["email", "ip", "card", "phone", "general", "term"]
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)"
CARD = r"[0-9]([\x20-]?+[0-9])++"
LONG_CARD = r"[0-9]([\x20-]?+[0-9]){12}"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WORD = r"[\p{L}][\p{L}\p{M}]*+"
FUNCTION_WORDS = "a an the and or but nor so yet if as at by for in of off on out per to up via am are be is was do did has had may can not no i me my we us our you he him his she her it its who how why all any".split()
COMMON_TERMS = 10_000  # sent to all tasks
SPAN = "array<struct<kind:string,start:int,end:int>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a digit string is right."""
    places = F.sequence(F.lit(1), F.char_length(digits))
    worth = F.transform(places, lambda i: F.substring(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _small_parts(value: Column) -> Column:
    """Every number of an address is at most 255, whatever zeros lead it."""
    plain = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    return F.forall(F.split(value, r"\."), lambda p: (F.char_length(plain(p)) <= 3) & (F.when(F.char_length(plain(p)) <= 3, plain(p)).otherwise("999").cast("int") <= 255))


def base_spans(text: Column) -> Column:
    """Array of struct(kind, start, end, value) of the four base kinds."""
    email = spans.matches(text, EMAIL)
    ip = F.filter(spans.matches(text, IP), lambda s: _small_parts(s["value"]))
    size = lambda s: F.char_length(_digits(s["value"]))
    card = F.when(text.rlike(LONG_CARD), F.filter(spans.matches(text, CARD), lambda s: F.when(size(s).between(13, 19), _luhn(_digits(s["value"]))).otherwise(False)))
    phone = F.filter(spans.matches(text, PHONE), lambda s: size(s).between(9, 15))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.concat(*[_of_kind(x, k) for k, x in zip(KINDS, (email, ip, F.coalesce(card, none), phone), strict=False)])


def _of_kind(found: Column, kind: str) -> Column:
    return F.transform(found, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))


def _disclosure(n: Column, n_t: Column, n_e: Column, n_te: Column, doubt: float) -> Column:
    """PMI / IC with the share of the term's documents that hold the entity shrunk towards the entity's base rate."""
    base, share = n_e / n, n_te / n_t
    rest = F.when((n_te < n_t) & (n_e < n), (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    chance = F.when(share > base, F.exp(-n_t * (share * F.log(share / base) + rest))).otherwise(1.0)
    weight = chance / (chance + doubt)
    return 1 + F.log((1 - weight) * share + weight * base) / F.greatest(-F.log(base), F.lit(1e-9))


def _most_documents(n: float, n_e: Column, generalise: float) -> Column:
    """The most documents a term may be in to reach ``generalise`` with an entity: its share is n_e / n_t at most. The factor covers rounding."""
    return n_e * F.exp((1 - generalise) * F.greatest(-F.log(n_e / n), F.lit(1e-9))) * (1 + 1e-9)


def disclosing_terms(docs: DataFrame, doubt: float = 0.05, generalise: float = 0.9, remove: float = 0.97) -> DataFrame:
    """doc_id, row_key, base (arrays of struct(kind, start, end)) and found (with the terms) of every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    raw = texts.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text", base_spans(F.col("text")).alias("base"))
    named = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.concat_ws(":", s["kind"], F.lower(F.when(s["kind"] == "email", s["value"]).otherwise(_digits(s["value"])))).alias("entity")))
    # the words of a text with an entity go along with it
    words = F.transform(spans.matches(F.col("text"), WORD), lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), F.lower(w["value"]).alias("term")))
    words = F.when(F.size("base") > 0, F.filter(words, lambda w: ~w["term"].isin(FUNCTION_WORDS)))
    scanned = written(raw.select("doc_id", "row_key", named.alias("base"), words.alias("words")))

    n = float(max(texts.agg(F.count(F.lit(1)).alias("n")).first()["n"], 1))
    in_docs = scanned.select("row_key", F.explode(F.array_distinct(F.transform("base", lambda b: b["entity"]))).alias("entity")).distinct()
    n_entity = written(in_docs.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")))
    all_words = texts.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))).alias("term"))
    # a term in more documents than any entity allows discloses nothing
    n_term = all_words.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    most = n_entity.agg(F.max(_most_documents(n, F.col("n_e"), generalise)).alias("most")).first()["most"]
    n_term = written(n_term.withColumn("rare", F.col("n_t") <= F.lit(float(most or 0.0))))
    common = n_term.where(~F.col("rare")).orderBy(F.desc("n_t"), "term").limit(COMMON_TERMS).select("term")

    seen = scanned.select("row_key", F.explode("words").alias("w"), "base").select("row_key", "w.*", "base")
    seen = seen.join(F.broadcast(common), "term", "left_anti")
    seen = seen.where(~F.exists("base", lambda b: (F.col("start") < b["end"]) & (F.col("end") > b["start"])))
    near = seen.groupBy("row_key", "term").agg(F.collect_set(F.struct("start", "end")).alias("places"))
    near = written(near.join(n_term.where("rare").drop("rare"), "term"))

    known = in_docs.join(n_entity, "entity").withColumn("most", _most_documents(n, F.col("n_e"), generalise))
    met = written(near.select("row_key", "term", "n_t").join(known, "row_key").where(F.col("n_t") <= F.col("most")).drop("most"))
    told = met.groupBy("term", "entity").agg(F.count(F.lit(1)).alias("n_te"), F.first("n_t").alias("n_t"), F.first("n_e").alias("n_e"))
    told = told.withColumn("disclosure", _disclosure(F.lit(n), F.col("n_t"), F.col("n_e"), F.col("n_te"), doubt))
    told = told.where(F.col("disclosure") >= generalise).select("term", "entity", F.when(F.col("disclosure") >= remove, "term").otherwise("general").alias("kind"))

    added = met.join(told, ["term", "entity"]).groupBy("row_key", "term").agg(F.max("kind").alias("kind"))  # of both kinds, removal
    added = near.join(added, ["row_key", "term"]).select("row_key", F.explode("places").alias("s"), "kind")
    added = added.groupBy("row_key").agg(F.collect_list(F.struct("kind", "s.start", "s.end")).alias("added"))
    base = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    out = scanned.select("doc_id", "row_key", "base").join(added, "row_key", "left").withColumn("base", spans.by_kind(base, KINDS))
    return out.select("doc_id", "row_key", "base", spans.by_kind(F.concat("base", F.coalesce("added", F.array().cast(SPAN))), KINDS).alias("found"))


def personal_data(docs: DataFrame, **parameters) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every document."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return disclosing_terms(docs, **parameters).select("doc_id", *[count(k) for k in KINDS[:4]], F.sha2(spans.listed(F.col("base")), 256).alias("base_sha256"), spans.listed(F.col("found")).alias("spans"))


def sanitised(docs: DataFrame, **parameters) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; overlapping spans are replaced as one, by the first one's kind. Removed terms leave nothing."""
    own, other, all_spans = (free_name(stem, docs) for stem in ("own_key", "other_key", "all_spans"))
    found = disclosing_terms(docs, **parameters).groupBy(F.col("row_key").alias(other)).agg(F.first("found").alias(all_spans))
    keyed = docs.withColumn(own, F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))))
    joined = keyed.join(found, F.col(own) == F.col(other), "left")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("done"))
    mark = lambda s: F.when(s["kind"] == "term", "").otherwise(F.concat(F.lit("<"), s["kind"], F.lit(">")))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.array(F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))), mark(s))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(acc["done"], piece)).otherwise(acc["done"]).alias("done"))

    ordered = spans.by_start(F.coalesce(all_spans, F.array().cast(SPAN)), KINDS)
    clean = F.aggregate(ordered, start, step, lambda acc: F.concat(F.array_join(acc["done"], ""), F.substring(text, acc["at"] + 1, F.char_length(text))))
    return joined.withColumn("text", F.when(F.col("text").isNull(), None).otherwise(clean)).select(*docs.columns)
