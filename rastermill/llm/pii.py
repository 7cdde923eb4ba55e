"""Personal data: fixed patterns, and terms that reveal protected values by co-occurrence.

DataFrame functions only. The patterns give the base spans. Every protected value (the matches) has
contexts: the REACH code points on either side of an occurrence; equal contexts of one value count
once, so copied text is no evidence. A term (a word of MIN_TERM letters or more) reveals value e if

    PMI(e, t) >= threshold * IC(e)     PMI = log2(p(e, t) / (p(e) p(t)))    IC = -log2 p(e)

with probabilities over documents: p(e) of those that hold e, p(t) of those that hold t anywhere, p(e, t)
of those where t stands in a context of e. A pair needs SUPPORT distinct contexts. Terms at
GENERALISE are replaced by a general token, terms at REMOVE go; every occurrence in every
document counts, since t reveals e wherever it stands.

Only (value, term) pairs within a context are formed, a bounded number for each occurrence.
The revealing terms are broadcast only while they are few (TERMS_BROADCAST); else they are joined
by shuffle. Patterns use possessive quantifiers, parts are cut from pieces of CHUNK code points and
sums run by groups, so a long text with many spans costs time in proportion.

Cases: null counts as empty text: no spans; kinds may overlap each other; repeated rows get equal
results and their texts count once for each row in p; ties do not matter; an empty table gives an
empty result; other columns are kept by `sanitised` and ignored elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Linear forms of the fixed patterns: a possessive run cannot match later where it failed, and a match
#: may start behind the one before it (\G) or where no run precedes.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without a match of this cannot match the pattern.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){12}", "phone": r"\+[0-9]"}
KINDS = tuple(PATTERNS)
TOKENS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}
REACH = 64
MIN_TERM = 2
SUPPORT = 3
GENERALISE, REMOVE = 0.8, 0.95
TERMS_BROADCAST = 50_000
WORD = rf"(?<!\p{{L}})\p{{L}}{{{MIN_TERM},}}+"
GROUP = 256
CHUNK = 256
SPAN = "array<struct<start:bigint,end:bigint,value:string>>"


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often body or a lambda in it uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _earlier(values: Column, op, zero: int) -> Column:
    """op over all earlier elements, for each element; by groups, so that the cost of long arrays is linear."""
    start = F.lit(zero).cast("bigint")

    def scan(xs: Column, first: Column) -> Column:
        state = F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(xs, state, lambda a, x: F.struct(op(a["at"], x).alias("at"), F.array_append(a["out"], a["at"]).alias("out")))["out"]

    def whole(groups: Column) -> Column:
        begin = scan(F.transform(groups, lambda g: F.aggregate(g, start, op)), start)
        return F.flatten(F.zip_with(groups, begin, scan))

    def run(xs: Column) -> Column:
        last = F.floor((F.size(xs) - 1) / GROUP).cast("int")
        groups = F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda g: F.slice(xs, g * GROUP + 1, F.lit(GROUP))))
        return _let(F.coalesce(groups, F.array().cast("array<array<bigint>>")), whole)

    return _let(values, run)


def _matches(text: Column, pattern: str) -> Column:
    """(start, end, value) of the leftmost non-overlapping matches, in code points, end exclusive."""

    def place(gaps: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        both = F.zip_with(found, F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0))), lambda m, g: F.struct(m.alias("m"), F.length(g).cast("bigint").alias("g"), F.length(m).cast("bigint").alias("n")))
        return _let(both, lambda rows: F.zip_with(rows, _earlier(F.transform(rows, lambda x: x["g"] + x["n"]), lambda a, x: a + x, 0), span))

    def span(x: Column, b: Column) -> Column:
        return F.struct((b + x["g"]).alias("start"), (b + x["g"] + x["n"]).alias("end"), x["m"].alias("value"))

    return _let(F.split(text, pattern, -1), place)


def _chunks(text: Column) -> Column:
    """The text in pieces of CHUNK code points, from which a part is cut without reading the text from its start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def _cut(chunks: Column, a: Column, b: Column) -> Column:
    """Code points a to b of the text."""
    first = F.floor(a / CHUNK)
    many = F.floor((b - 1) / CHUNK) - first + 1
    part = F.array_join(F.slice(chunks, (first + 1).cast("int"), many.cast("int")), "")
    return F.when(b > a, F.substring(part, (a - first * CHUNK + 1).cast("int"), (b - a).cast("int"))).otherwise(F.lit(""))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d < 5, d * 2).otherwise(d * 2 - 9)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(F.when(F.length(part(p)).between(1, 3), part(p).cast("int")), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(F.length(_digits(value)).between(13, 19), _luhn(_digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(docs: DataFrame) -> DataFrame:
    """docs with an array of spans for each kind, in columns _email, _ip, _card and _phone; null text becomes empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast(SPAN)

    def spans(kind: str) -> Column:
        hint = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(HINTS[kind])
        return F.when(hint, F.filter(_matches(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))).otherwise(none)

    return docs.withColumn("text", text).withColumns({f"_{kind}": spans(kind) for kind in KINDS})


def _normal(kind: str, value: Column) -> Column:
    """The same protected value in whatever way it is written."""
    return F.concat(F.lit(kind + ":"), F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value))


def contexts(text: Column) -> Column:
    """(entity, context, terms) of each occurrence of a protected value, from the spans in _email, _ip, _card and _phone."""

    def entities(kind: str) -> Column:
        return F.transform(f"_{kind}", lambda s: F.struct(_normal(kind, s["value"]).alias("entity"), s["start"].alias("start"), s["end"].alias("end")))

    def within(n: Column) -> Column:
        return _let(_chunks(text), lambda chunks: F.transform(F.concat(*map(entities, KINDS)), lambda s: one(s, chunks, n)))

    def one(s: Column, chunks: Column, n: Column) -> Column:
        low, high = F.greatest(s["start"] - REACH, F.lit(0)), F.least(s["end"] + REACH, n)
        left, right = _cut(chunks, low, s["start"]), _cut(chunks, s["end"], high)
        # Words that the ends of the context cut are left out.
        left = F.when(low > 0, F.regexp_replace(left, r"^\p{L}+", "")).otherwise(left)
        right = F.when(high < n, F.regexp_replace(right, r"\p{L}+$", "")).otherwise(right)
        words = F.regexp_extract_all(F.concat(left, F.lit(" "), right), F.lit(WORD), F.lit(0))
        return F.struct(s["entity"].alias("entity"), F.xxhash64(left, right).alias("context"), F.array_distinct(F.transform(words, F.lower)).alias("terms"))

    return F.when(F.expr(" OR ".join(f"size(_{k}) > 0" for k in KINDS)), _let(F.length(text).cast("bigint"), within))


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, _row (a hash of doc_id and text), the base spans and the contexts of every document; stored, without the texts."""
    from .shared import stored

    found = base_spans(docs.select("doc_id", "text"))
    return stored(found.select("doc_id", _row(), *[f"_{k}" for k in KINDS], contexts(F.col("text")).alias("_contexts")), "spans")


def _row() -> Column:
    return F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("_row")


def _words(docs: DataFrame) -> DataFrame:
    """(_row, term) of the distinct terms of every document."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    return docs.select(_row(), F.explode(F.array_distinct(F.transform(words, F.lower))).alias("term"))


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of (a number and) a term, to be broadcast if they are few."""
    return F.broadcast(rows) if rows.limit(TERMS_BROADCAST + 1).count() <= TERMS_BROADCAST else rows


def revealing_terms(docs: DataFrame, scan: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(_row, term, strength) of every document that holds a revealing term; strength is the term's largest PMI / IC."""
    from .shared import stored

    none = docs.sparkSession.createDataFrame([], "_row long, term string, strength double")
    seen = scan.where("_contexts IS NOT NULL").select("_row", F.explode("_contexts").alias("c")).select("_row", "c.*")
    pair = seen.select("_row", "entity", "context", F.explode("terms").alias("term"))
    # Two steps, so that a frequent pair is counted from distinct contexts without holding them together.
    backed = pair.select("entity", "term", "context").distinct().groupBy("entity", "term").agg(F.count("*").alias("n")).where(F.col("n") >= support)
    backed = stored(backed.select("entity", "term"), "backed")
    if backed.isEmpty():
        return none
    total = float(scan.count())
    n_entity = seen.select("entity", "_row").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    n_seen = pair.select("term", "_row").distinct().groupBy("term").agg(F.count("*").alias("n_seen"))
    both = pair.join(backed, ["entity", "term"], "left_semi").select("entity", "term", "_row").distinct().groupBy("entity", "term").agg(F.count("*").alias("n_both"))
    ic = F.log2(F.lit(total) / F.col("n_entity"))

    def strength(n_term: str) -> Column:
        return F.when(ic > 0, F.log2(F.col("n_both") * F.lit(total) / (F.col("n_entity") * F.greatest(n_term, "n_both"))) / ic)

    # A term is in at least as many documents as have it in a context: what is too weak by that need not be counted.
    both = stored(both.join(n_entity, "entity").join(n_seen, "term").where(strength("n_seen") >= GENERALISE), "pairs")
    if both.isEmpty():
        return none
    # Documents of every term, by a partial aggregate: what is joined has one row for each term.
    n_term = _words(docs).groupBy("term").agg(F.count("*").alias("n_term"))
    scored = both.join(n_term, "term").withColumn("strength", strength("n_term"))
    strong = scored.groupBy("term").agg(F.max("strength").alias("strength")).where(F.col("strength") >= GENERALISE)
    strong = stored(strong, "strong")
    if strong.isEmpty():
        return none
    return stored(_words(docs).join(_sized(strong), "term").select("_row", "term", "strength"), "terms")


TERM_SPAN = "array<struct<start:bigint,end:bigint,value:string,strength:double>>"


def with_terms(docs: DataFrame, held: DataFrame, how: str) -> DataFrame:
    """docs (doc_id, text, ...) joined to their revealing terms by _row, with _term: their spans (null where there is none)."""
    few = held.limit(TERMS_BROADCAST + 1).count() <= TERMS_BROADCAST
    by_row = held.groupBy("_row").agg(F.map_from_entries(F.collect_set(F.struct("term", "strength"))).alias("_reveals"))
    marked = docs.withColumn("_row", _row()).join(F.broadcast(by_row) if few else by_row, "_row", how)
    spans = F.filter(_matches(F.col("text"), WORD), lambda s: F.map_contains_key(F.col("_reveals"), F.lower(s["value"])))
    spans = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), F.try_element_at(F.col("_reveals"), F.lower(s["value"])).alias("strength")))
    return marked.withColumn("_term", F.when(F.col("_reveals").isNotNull(), spans).cast(TERM_SPAN)).drop("_reveals")


def _listed(kinds: tuple[str, ...]) -> Column:
    def one(kind: str) -> Column:
        return F.transform(f"_{kind}", lambda s: F.concat(F.lit(kind + ":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))

    return F.concat_ws(",", F.concat(*map(one, kinds)))


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, their digest, and all spans.

    The patterns run once; texts are read again only for revealing terms, and no text is shuffled while these are few.
    """
    from .shared import stored

    docs = docs.select("doc_id", "text")
    scan = scanned(docs)
    held = revealing_terms(docs, scan)
    found = with_terms(docs, held, "inner").select("_row", "_term").dropDuplicates(["_row"])
    found = scan.join(stored(found, "term_spans"), "_row", "left").withColumn("_term", F.coalesce("_term", F.array().cast(TERM_SPAN)))
    return found.select(
        "doc_id",
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_listed(KINDS), 256).alias("base_sha256"),
        _listed((*KINDS, "term")).alias("spans"),
        F.size("_term").cast("long").alias("n_term"),
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """docs with every span of `text` replaced by its kind's token or removed; where spans overlap, the first one's token stands."""
    held = revealing_terms(docs.select("doc_id", "text"), scanned(docs))
    rows = docs.select("doc_id", "text", F.struct(*[c for c in docs.columns if c != "text"]).alias("_rest"))
    found = base_spans(with_terms(rows, held, "left")).withColumn("_term", F.coalesce("_term", F.array().cast(TERM_SPAN)))

    def tokens(kind: str) -> Column:
        return F.transform(f"_{kind}", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(TOKENS[kind]).alias("token")))

    term = F.transform("_term", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["strength"] >= REMOVE, F.lit("")).otherwise(F.lit(TOKENS["term"])).alias("token")))
    text = F.col("text")

    def replaced(spans: Column) -> Column:
        """The text between the ends of all earlier spans and each start, with the token of each span that begins there."""
        ends = F.transform(spans, lambda s: s["end"])
        before = _earlier(ends, lambda a, x: F.greatest(a, x), 0)
        rows = F.zip_with(spans, before, lambda s, b: F.struct(s["start"].alias("start"), s["token"].alias("token"), b.alias("at")))
        rows = F.filter(rows, lambda r: r["start"] >= r["at"])
        last = F.array_max(ends)

        def joined(chunks: Column) -> Column:
            parts = F.transform(rows, lambda r: F.concat(_cut(chunks, r["at"], r["start"]), r["token"]))
            return F.concat(F.array_join(parts, ""), _cut(chunks, last, F.length(text).cast("bigint")))

        return _let(_chunks(text), joined)

    spans = F.array_sort(F.concat(*map(tokens, KINDS), term))
    clean = F.when(F.size(F.col("_all")) > 0, _let(F.col("_all"), replaced)).otherwise(text)
    found = found.withColumn("_all", spans).withColumn("_clean", clean)
    return found.select(*[F.col("_clean").alias("text") if c == "text" else F.col("_rest").getField(c).alias(c) for c in docs.columns])
