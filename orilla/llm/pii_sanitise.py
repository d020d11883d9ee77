"""Information-theoretic sanitisation of personal data (operator 4), native.

Only DataFrame and SQL functions are used. Patterns find e-mail and IP
addresses, card and phone numbers. Then the corpus tells which other terms give
a protected entity away: an entity is a value that was found, its information
content is ``IC(e) = log2(N / n(e))``, and a term of its documents discloses
``PMI(e; t) = log2(N * n(e, t) / (n(e) * n(t)))`` of it, all counts being over
documents. Terms whose share ``PMI / IC`` exceeds a threshold are generalised to
their class, and beyond a second threshold removed, wherever they occur in the
entity's documents (``sanitise`` gives the texts, ``find_pii`` the spans). Counts are exact, over all documents. Terms are whole words; one that a pattern's span touches with a
letter is none. Entities and pairs need a least support in different texts, so that
copies of one text alone prove nothing.

Positions count code points. A pattern's matches and the pieces between them
(``split``) give every start, without a Python worker.

Defined cases: a null or empty text has no spans. Rows that repeat, null ids and
further columns change nothing: one row comes out for each row in. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orilla.llm import workspace

KINDS = ("email", "ip", "card", "phone")
# a match starts where the one before ended or where no character of its class stands before;
# possessive classes keep long runs linear
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_OK = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
MARK = "\ufdd0"  # not a character of any text
TERM = rf"(?<![\p{{L}}{MARK}])\p{{L}}{{3,}}+(?!{MARK})"
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"
PART = 256


def _matches(text: Column, pattern: str, kind: int, base: Column | None = None, among: Column | None = None) -> Column:
    """The spans of a pattern's matches in ``text``, which stands at ``base`` in its document; only those ``among`` some lower-case values."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    at = F.coalesce(base, F.lit(0)).cast("int") if base is not None else F.lit(0)
    none = F.array().cast(SPAN)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        one = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["hit"].alias("value")))
        skip = x["hit"].isNull() if among is None else x["hit"].isNull() | ~F.array_contains(among, F.lower(x["hit"]))
        full = F.size(acc["open"]) >= PART
        # spans gather in parts, so that long lists aren't copied for every match
        done = F.when(~skip & full, F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"])
        left = F.when(skip, acc["open"]).when(full, one).otherwise(F.concat(acc["open"], one))
        return F.struct(end.alias("at"), done.alias("done"), left.alias("open"))

    first = F.struct(at.alias("at"), F.array().cast(f"array<{SPAN}>").alias("done"), none.alias("open"))
    fold = F.aggregate(F.arrays_zip(gaps.alias("gap"), found.alias("hit")), first, step, lambda acc: F.concat(F.flatten(acc["done"]), acc["open"]))
    return F.when(F.size(found) > 0, fold).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn's check of a digit string."""
    each = F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(d.cast("int") > 4, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int"))))
    return F.aggregate(F.filter(each, lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x) % 10 == 0


def card_spans(text: Column) -> Column:
    """Card numbers: within runs of digits and separators, the parts between doubled separators."""
    runs = _matches(text, r"[0-9][0-9\x20-]{12,}[0-9]", 2)
    parts = F.flatten(F.transform(runs, lambda r: _matches(r["value"], r"[0-9]++(?:[\x20-][0-9]++)*+", 2, r["start"])))
    return F.filter(parts, lambda s: (F.length(_digits(s["value"])).between(14, 19)) & luhn(_digits(s["value"])))


def base_spans(text: Column) -> Column:
    """All pattern spans by start, then kind."""
    none = F.array().cast(SPAN)
    email = F.when(F.contains(text, F.lit("@")), _matches(text, EMAIL, 0)).otherwise(none)
    digit = text.rlike(r"[0-9][0-9\x20-]{12}|[0-9]\.[0-9]")
    ip = F.when(digit, F.filter(_matches(text, IP, 1), lambda s: s["value"].rlike(IP_OK))).otherwise(none)
    card = F.when(digit, card_spans(text)).otherwise(none)
    phone = F.when(F.contains(text, F.lit("+")), F.filter(_matches(text, PHONE, 3), lambda s: F.length(_digits(s["value"])).between(10, 15))).otherwise(none)
    return F.array_sort(F.concat(email, ip, card, phone))


def _join(spans: Column, names: tuple[str, ...]) -> Column:
    of = F.array(*(F.lit(n) for n in names))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(of, s["kind"]), s["start"], s["end"])), ",")


def masked(text: Column) -> Column:
    """The text with the letters of its base spans replaced by a mark and their other characters by blanks: every place stays."""

    def step(acc: Column, s: Column) -> Column:
        lo = F.greatest(acc["at"], s["start"])
        cover = F.regexp_replace(F.regexp_replace(F.substring(text, lo + 1, F.greatest(s["end"] - lo, F.lit(0))), r"\p{L}", MARK), f"[^{MARK}]", " ")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))), cover).alias("out"))

    return F.aggregate("base", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def disclosing(found: DataFrame, documents: DataFrame, support: int, generalise: float, remove: float, broadcast_rows: int = 100_000) -> DataFrame:
    """(entity, term, share, removed) of the terms that give an entity away.

    Candidate pairs have the support; only their terms are counted over the corpus. Counts are
    over documents, copies included, each text's copies being counted once beforehand; support
    is over different texts. The candidates' number is checked before they are broadcast; else
    both sides shuffle.
    """
    total = documents.count() or 1
    held = found.groupBy("text_key").agg(F.count("*").alias("copies"), F.first("entities").alias("entities"))
    entities = held.select("text_key", "copies", F.explode("entities").alias("entity"))
    # n_e bounds n_et from above, so that rarer entities have no pair
    n_e = entities.groupBy("entity").agg(F.count("*").alias("s_e"), F.sum("copies").alias("n_e")).where((F.col("s_e") >= support) & (F.col("n_e") < total)).drop("s_e")
    held = workspace.materialize(entities.join(n_e, "entity"), "pii_entities")
    reach = F.pow(F.lit(float(total)) / F.col("n_e"), F.lit(1 - generalise))
    # a term of more documents than this can't reach the threshold with any of a text's entities
    texts = held.groupBy("text_key").agg(F.max(F.col("n_e") * reach).alias("most"), F.first("copies").alias("copies"))
    bag = F.array_distinct(F.regexp_extract_all(F.lower("masked"), F.lit(TERM), F.lit(0)))
    bags = workspace.materialize(found.dropDuplicates(["text_key"]).join(texts, "text_key").select("text_key", "most", "copies", F.explode(bag).alias("term")), "pii_terms")
    # n_near bounds n_t from below
    n_near = bags.groupBy("term").agg(F.count("*").alias("s_near"), F.sum("copies").alias("n_near")).where(F.col("s_near") >= support).drop("s_near")
    rare = bags.join(n_near, "term").where(F.col("n_near") <= F.col("most")).select("text_key", "term", "n_near")
    pairs = held.join(rare, "text_key").where(F.col("n_near") <= F.col("n_e") * reach)
    pairs = pairs.groupBy("entity", "term").agg(F.count("*").alias("s_et"), F.sum("copies").alias("n_et"), F.first("n_e").alias("n_e"), F.first("n_near").alias("n_near"))
    pairs = workspace.materialize(pairs.where((F.col("s_et") >= support) & (F.col("n_near") <= F.col("n_et") * reach)), "pii_pairs")
    terms = pairs.select("term").distinct()
    n_terms = terms.count()
    if n_terms == 0:
        return pairs.select("entity", "term", F.lit(0.0).alias("share"), F.lit(False).alias("removed"))
    bags = documents.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}+"), F.lit(0)))).alias("term"))
    bags = bags.join(F.broadcast(terms) if n_terms <= broadcast_rows else terms, "term", "left_semi")
    n_t = bags.groupBy("term").agg(F.count("*").alias("n_t"))
    ic = F.log2(F.lit(float(total)) / F.col("n_e"))
    pmi = F.log2(F.lit(float(total)) * F.col("n_et") / (F.col("n_e") * F.greatest("n_t", "n_near", "n_et")))
    rated = pairs.join(n_t, "term").withColumn("share", pmi / ic)
    return rated.where(F.col("share") >= generalise).select("entity", "term", "share", (F.col("share") >= remove).alias("removed"))


def _spans(docs: DataFrame, id_col: str, text_col: str, support: int, generalise: float, remove: float) -> tuple[DataFrame, DataFrame]:
    """(id, text_key, base of every row; text_key, base, masked, terms of every text that has spans)."""
    text = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    documents = text.select(F.xxhash64("text").alias("text_key"), "text")
    hit = text.withColumn("base", base_spans(F.col("text"))).withColumn("text_key", F.xxhash64("text"))
    some = F.size("base") > 0
    entities = F.array_distinct(F.transform("base", lambda s: F.lower(s["value"])))
    slim = workspace.materialize(hit.select(F.col(id_col).alias("id"), "text_key", "base", F.when(some, entities).alias("entities"), F.when(some, masked(F.col("text"))).alias("masked")), "pii")
    found = slim.where(F.col("masked").isNotNull())
    told = disclosing(found, documents, support, generalise, remove)
    # rows of one text get the same spans
    each = found.dropDuplicates(["text_key"])
    sets = (F.collect_set(F.when(c, F.col("term"))).alias(n) for n, c in (("mild", ~F.col("removed")), ("hard", F.col("removed"))))
    marked = each.select("text_key", F.explode("entities").alias("entity")).join(told, "entity").groupBy("text_key").agg(*sets)
    slim_span = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    both = F.concat(*(F.transform(_matches(F.col("masked"), TERM, k, among=F.col(c)), slim_span) for k, c in ((4, "mild"), (5, "hard"))))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    extra = each.join(marked, "text_key", "left").select("text_key", F.transform("base", slim_span).alias("base"), "masked", F.when(F.col("mild").isNull(), none).otherwise(both).alias("terms"))
    return slim.select("id", "text_key", F.transform("base", slim_span).alias("base")), extra


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = 3, generalise: float = 0.8, remove: float = 0.95) -> DataFrame:
    """id, counts, and all spans: the patterns' and those of terms to generalise or remove.

    Columns: id, n_email, n_ip, n_card, n_phone, n_term, base_sha256, spans.
    """
    slim, extra = _spans(docs, id_col, text_col, support, generalise, remove)
    out = slim.join(extra.where(F.size("terms") > 0).select("text_key", "terms"), "text_key", "left")
    terms = F.coalesce("terms", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return out.select(F.col("id").alias(id_col), *(count(k).alias(f"n_{n}") for k, n in enumerate(KINDS)), F.size(terms).cast("long").alias("n_term"), F.sha2(_join(F.col("base"), KINDS), 256).alias("base_sha256"), _join(F.array_sort(F.concat("base", terms)), (*KINDS, "generalise", "remove")).alias("spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = 3, generalise: float = 0.8, remove: float = 0.95) -> DataFrame:
    """All columns, the text with its spans replaced: patterns by their kind in brackets, terms to generalise by their
    class ([name] for one with a capital, else [word]), terms to remove by nothing. A null text stays null."""
    _, extra = _spans(docs, id_col, text_col, support, generalise, remove)
    text = F.col("masked")
    of = F.array(*(F.lit(f"[{k}]") for k in KINDS))

    def step(acc: Column, s: Column) -> Column:
        word = F.substring(text, s["start"] + 1, F.lit(1))
        label = F.when(s["kind"] < len(KINDS), F.get(of, s["kind"])).when(s["kind"] == len(KINDS) + 1, "").when(word.rlike(r"\p{Lu}"), "[name]").otherwise("[word]")
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        # of spans that overlap the first one's label stands
        shown = F.when(s["start"] >= acc["at"], F.concat(gap, label)).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], shown).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(F.array_sort(F.concat("base", "terms")), start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    cleaned = extra.select("text_key", clean.alias("clean"))
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.xxhash64(F.coalesce(docs[text_col], F.lit(""))).alias("text_key"))
    joined = rows.join(cleaned.hint("merge"), "text_key", "left")
    return joined.select(*(F.coalesce("clean", F.col("row")[c]).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
