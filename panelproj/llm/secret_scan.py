"""Secrets in texts: three base detectors, and weak parts of credentials linked within scopes.

A credential has parts: an identifier of an access (an account, a key id), a secret, and an
endpoint it opens. Taken alone a short password, a user name or a URL says little. Such weak
candidates are reported only where complementary parts co-occur within a scope of ``scope``
code points in the same document: an identifier near a secret, a secret near an identifier or
an endpoint, an endpoint near both an identifier and a secret. Parts of all three roles are
rows keyed by document and by the blocks of text they reach; an equi-join on document and block
with a check of the distance is the interval join, so parts far apart never meet.

Spans added to the base kinds: ``identifier``, ``weak_secret``, ``endpoint``.

Native functions only. What is carried between stages is the spans, not the texts.

Defined cases: a null text is empty; rows with equal id and text (and rows without id but equal
text) are scanned alike and each keeps its own output row; extra columns are ignored; an empty
table gives an empty result.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelproj.llm import spans
from panelproj.llm.shared import checkpointed

KINDS = ["assign", "access", "hex", "identifier", "weak_secret", "endpoint"]
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"
IDENTIFIER = r"""(?i)\b(?:user(?:_?name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@+/_.-]{3,}+"""
ENDPOINT = r"""(?i)\b(?:https?|ftps?|sftp|ssh|jdbc:[a-z]++|postgres(?:ql)?|mysql|mongodb|redis|amqps?)://[^\x20\x09-\x0D"'<>]++"""
LEAST_SECRET, LEAST_WEAK = 12, 6
SPAN = "array<struct<kind:string,start:int,end:int>>"


def _assigned(text: Column) -> Column:
    """Matches of the assign pattern with the length of the assigned value."""
    value = lambda v: F.char_length(F.regexp_extract(v, ASSIGN, 2))
    return F.transform(spans.matches(text, ASSIGN), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), value(s["value"]).alias("size")))


def secret_spans(docs: DataFrame, scope: int = 200) -> DataFrame:
    """doc_id, base and found (arrays of struct(kind, start, end), sorted by start) of every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    raw = texts.select(
        "doc_id",
        F.xxhash64("doc_id", "text").alias("row_key"),
        _assigned(text).alias("assign"),
        spans.matches(text, ACCESS).alias("access"),
        spans.matches(text, HEX).alias("hex"),
        spans.matches(text, IDENTIFIER).alias("identifier"),
        spans.matches(text, ENDPOINT).alias("endpoint"),
    )
    strong = F.filter("assign", lambda s: s["size"] >= LEAST_SECRET)
    weak = F.filter("assign", lambda s: (s["size"] >= LEAST_WEAK) & (s["size"] < LEAST_SECRET))
    base = F.concat(spans.as_kind(strong, "assign"), spans.as_kind(F.col("access"), "access"), spans.as_kind(F.col("hex"), "hex"))
    parts = F.concat(spans.as_kind(F.col("identifier"), "identifier"), spans.as_kind(weak, "weak_secret"), spans.as_kind(F.col("endpoint"), "endpoint"))
    scanned = checkpointed(raw.select("doc_id", "row_key", spans.by_start(base, KINDS).alias("base"), parts.cast(SPAN).alias("parts")))

    linked = _linked(scanned, scope)
    added = linked.groupBy("row_key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    found = spans.by_start(F.concat("base", F.coalesce("added", F.array().cast(SPAN))), KINDS)
    return scanned.join(added, "row_key", "left").select("doc_id", "base", found.alias("found"))


def _linked(scanned: DataFrame, scope: int) -> DataFrame:
    """row_key, kind, start and end of the weak parts with the complementary parts near them."""
    role = F.when(F.col("kind").isin("identifier", "access"), "identifier").when(F.col("kind") == "endpoint", "endpoint").otherwise("secret")
    rows = scanned.where(F.size("parts") > 0).select("row_key", F.explode(F.concat("base", "parts")).alias("s")).select("row_key", "s.*").distinct().withColumn("role", role)
    block = lambda c: F.floor(c / scope)
    weak = rows.where(F.col("kind").isin("identifier", "weak_secret", "endpoint")).withColumn("block", F.explode(F.sequence(block(F.col("start")), block(F.col("end")))))
    near = rows.select("row_key", F.col("role").alias("other_role"), F.col("start").alias("from"), F.col("end").alias("to"))
    near = near.withColumn("block", F.explode(F.sequence(block(F.greatest(F.col("from") - scope, F.lit(0))), block(F.col("to") + scope))))
    complementary = ((F.col("role") == "secret") & F.col("other_role").isin("identifier", "endpoint")) | ((F.col("role") == "identifier") & (F.col("other_role") == "secret")) | ((F.col("role") == "endpoint") & F.col("other_role").isin("identifier", "secret"))
    meet = weak.join(near, ["row_key", "block"]).where(complementary & (F.col("from") <= F.col("end") + scope) & (F.col("start") <= F.col("to") + scope))
    roles = meet.groupBy("row_key", "kind", "start", "end", "role").agg(F.max((F.col("other_role") == "identifier").cast("int")).alias("i"), F.max((F.col("other_role") == "secret").cast("int")).alias("s"))
    return roles.where((F.col("role") != "endpoint") | (F.col("i") + F.col("s") == 2)).select("row_key", "kind", "start", "end")


def secret_scan(docs: DataFrame, scope: int = 200) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every document."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return secret_spans(docs, scope).select("doc_id", *[count(k) for k in KINDS[:3]], F.sha2(spans.listed(F.col("base")), 256).alias("base_sha256"), spans.listed(F.col("found")).alias("spans"))
