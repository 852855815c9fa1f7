"""Information-theoretic sanitisation of personal data (operator 1).

Protected entities are what four patterns find: e-mail and IP addresses, payment cards
and telephone numbers. A term reveals an entity as far as knowing the term tells that
the entity is near: the pointwise mutual information of the two as a share of the
entity's own information, ``log(P(e|t) / P(e)) / log(1 / P(e))``, estimated from the
corpus. All counts are of distinct texts, so copies count once: those with the entity,
those with the term, those with the term in a context of the entity, and all. A pair
needs a few distinct contexts besides. Terms above the first threshold are generalised
wherever they occur, above the second removed; base entities always become their kind.

All work is column expressions and joins. What is exploded is the contexts of the
entities and, for the counts, the words of each document; counts are summed up before
they are shuffled, and terms are broadcast only after their size was measured.

A term is any run of letters and digits, whatever its length; where words are not set
apart, it is all that stands between two other characters.

A null text is an empty one. Texts of any length are searched whole, in time linear in
their length but for the number of their spans. Rows without spans keep their text. Repeated rows are
found alike. Spans are in code points, ends exclusive, by start, then kind; a term
inside a base span is no span of its own. Extra columns are ignored or kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resultlake.llm.common import col, fresh, small
from resultlake.session import stage

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# Possessive forms match what the plain ones do, without deep backtracking, and try a run
# at its start or where the last match ended only, as what fails there fails further on;
# the card pattern takes the maximal runs that have 12 to 19 digits.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be worth trying.
HINTS = {"email": "@", "phone": "+"}
# Code points of a context on either side, contexts that support an entity or a pair.
CONTEXT, SUPPORT = 100, 3
GENERALISE, REMOVE = 0.8, 0.95
# Words of letters, with their marks, and digits.
IN_WORD = r"[\p{L}\p{M}\p{N}]"
WORDS = IN_WORD + "+"
GENERALISED, REMOVED = "<WORD>", ""

_SPAN = "array<struct<start: int, kind: int, end: int, found: string>>"


def _none() -> Column:
    return F.array().cast(_SPAN)


def _located(text: Column, pattern: Column, kind: int) -> Column:
    """Matches with their places: the stretches between matches add up to them."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    pairs = F.arrays_zip(between.alias("gap"), found.alias("hit"))

    def add(done: Column, pair: Column) -> Column:
        start = done["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        span = F.struct(
            start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["hit"].alias("found")
        )
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), _none().alias("spans"))
    return F.aggregate(pairs, start, add, lambda done: done["spans"])


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _small_number(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)


def _luhn(digits: Column) -> Column:
    def add(total: Column, place: Column) -> Column:
        digit = F.substr(digits, place, F.lit(1)).cast("int")
        twice = (F.length(digits) - place) % 2 == 1
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(twice, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


_HOLDS = {
    "email": lambda found: F.lit(True),
    "ip": lambda found: F.forall(F.split(found, r"\."), _small_number),
    "card": lambda found: _luhn(_digits(found)),
    "phone": lambda found: F.length(_digits(found)).between(9, 15),
}


def _on_found(holds):
    return lambda span: holds(span["found"])


def base_spans(text: Column) -> Column:
    """All base entities of a text, by start, then kind."""
    parts = []
    for number, kind in enumerate(KINDS):
        hint = F.contains(text, F.lit(HINTS[kind])) if kind in HINTS else F.regexp_like(text, F.lit(PATTERNS[kind]))
        holds = _HOLDS[kind]
        spans = F.filter(_located(text, F.lit(PATTERNS[kind]), number), _on_found(holds))
        parts.append(F.when(hint, spans).otherwise(_none()))
    return F.array_sort(F.concat(*parts))


def _contexts(docs: DataFrame) -> DataFrame:
    """``entity, source, context, terms`` of every base entity: the text it is in, the
    words around it, as a set, and hashes of both; equal contexts of a text once."""
    spans = docs.select("text", _source(F.col("text")).alias("source"), F.explode(base_spans(F.col("text"))).alias("s"))
    text, start, end = F.col("text"), F.col("s.start"), F.col("s.end")
    first = F.greatest(start - CONTEXT, F.lit(0))
    before = F.substr(text, first + 1, start - first)
    # Words cut by a context's outer ends are not words.
    before = F.when(first > 0, F.regexp_replace(before, r"^\S+", "")).otherwise(before)
    after = F.substr(text, end + 1, F.lit(CONTEXT))
    after = F.when(F.length(after) == CONTEXT, F.regexp_replace(after, r"\S+$", "")).otherwise(after)
    around = F.lower(F.concat(before, F.lit(" | "), after))
    value = F.when(F.col("s.kind") < 2, F.lower("s.found")).otherwise(_digits(F.col("s.found")))
    words = F.array_sort(F.array_distinct(F.regexp_extract_all(around, F.lit(WORDS), F.lit(0))))
    return (
        spans.select(
            F.concat(F.col("s.kind").cast("string"), F.lit(":"), value).alias("entity"), "source", words.alias("terms")
        )
        .withColumn("context", F.xxhash64("terms"))
        .groupBy("entity", "source", "context")
        .agg(F.first("terms").alias("terms"))
    )


def disclosing_terms(
    docs: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE
) -> DataFrame:
    """``term, removed`` of ``docs (text)``, staged: what reveals some entity too well."""
    contexts = stage(_contexts(docs), "contexts")
    entities = contexts.groupBy("entity").agg(F.count_distinct("source").alias("n_entity"))
    together = contexts.select("entity", "source", "context", F.explode("terms").alias("term"))
    # Texts that hold the term near any entity: at most those that hold it at all.
    near = together.select("term", "source").distinct().groupBy("term").agg(F.count("*").alias("n_near"))
    total = docs.select(_source(F.col("text"))).distinct().count()
    prior = F.least(F.lit(1.0), F.col("n_entity") / F.lit(float(max(1, total))))

    def told(count: Column) -> Column:
        given = F.least(F.lit(1.0), F.col("n_both") / count)
        return F.when(prior < 1, F.log(given / prior) / F.log(1 / prior)).otherwise(F.lit(0.0))

    # What is common around entities is settled here and never looked for in the corpus.
    pairs = (
        together.groupBy("entity", "term")
        .agg(F.count_distinct("context").alias("n_contexts"), F.count_distinct("source").alias("n_both"))
        .where(F.col("n_contexts") >= support)
        .join(entities, "entity")
        .join(near, "term")
        .where(told(F.col("n_near")) >= generalise)
    )
    pairs = stage(pairs, "entity-terms")
    empty = pairs.select("term", F.lit(False).alias("removed")).limit(0)
    if pairs.isEmpty():
        return empty
    asked = stage(pairs.select("term").distinct(), "terms")
    words = docs.select(_source(F.col("text")).alias("source"), F.explode(_words(F.col("text"))).alias("term"))
    held = words.join(small(asked), "term").distinct()
    counts = held.groupBy("term").agg(F.count("*").alias("n_term"))
    scored = pairs.join(counts, "term").groupBy("term").agg(F.max(told(F.col("n_term"))).alias("told"))
    chosen = scored.where(F.col("told") >= generalise).select("term", (F.col("told") >= remove).alias("removed"))
    return stage(chosen, "disclosing")


def _source(text: Column) -> Column:
    """What equal texts have in common."""
    return F.xxhash64(text)


def _words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0)))


def _term_spans(text: Column, terms: Column) -> Column:
    pattern = F.concat(F.lit(f"(?iu)(?<!{IN_WORD})(?:"), F.array_join(terms, "|"), F.lit(f")(?!{IN_WORD})"))
    return F.when(F.size(terms) > 0, _located(text, pattern, len(KINDS))).otherwise(_none())


def _sanitised(text: Column, spans: Column, removed: Column) -> Column:
    tags = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))

    def add(done: Column, span: Column) -> Column:
        gone = F.array_contains(removed, F.lower(span["found"]))
        term = F.when(gone, F.lit(REMOVED)).otherwise(F.lit(GENERALISED))
        tag = F.when(span["kind"] < len(KINDS), F.element_at(tags, F.least(span["kind"] + 1, F.lit(len(KINDS))))).otherwise(term)
        gap = F.substr(text, done["at"] + 1, span["start"] - done["at"])
        pieces = F.concat(done["pieces"], F.array(gap, tag))
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.when(span["start"] >= done["at"], pieces).otherwise(done["pieces"]).alias("pieces"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("pieces"))
    joined = F.aggregate(
        spans, start, add, lambda done: F.concat(F.array_join(done["pieces"], ""), F.substr(text, done["at"] + 1))
    )
    return F.when(F.size(spans) > 0, joined).otherwise(text)


def sanitise(docs: DataFrame, terms: DataFrame | None = None, name: str = "pii") -> DataFrame:
    """All columns of ``docs (doc_id, text)`` and a struct named ``name``: ``base`` and
    ``spans`` (start, kind, end, found) and the sanitised ``text``. Terms come from
    ``docs`` if none are given."""
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select("doc_id", body.alias("text"))
    terms = disclosing_terms(plain) if terms is None else terms
    key, hit_id, hit_key, hit, found_base, found_terms, found_removed, found_spans = (
        fresh(docs, f"pii_{n}") for n in ("text", "hit_id", "hit_key", "hit", "base", "terms", "removed", "spans")
    )
    hit_type = "array<struct<term: string, removed: boolean>>"
    marked = docs.withColumn(key, F.xxhash64(body))
    if terms.isEmpty():
        found = marked.withColumn(hit, F.lit(None).cast(hit_type))
    else:
        words = plain.select("doc_id", F.xxhash64("text").alias(hit_key), F.explode(_words(F.col("text"))).alias("term"))
        hits = (
            words.join(small(terms), "term")
            .groupBy(F.col("doc_id").alias(hit_id), hit_key)
            .agg(F.collect_set(F.struct("term", "removed")).alias(hit))  # a document's own words
        )
        same = F.col("doc_id").eqNullSafe(F.col(hit_id)) & (F.col(key) == F.col(hit_key))
        found = marked.join(small(stage(hits, "term-hits")), same, "left")
    own = F.coalesce(F.col(hit), F.array().cast(hit_type))
    removed = F.transform(F.filter(own, lambda t: t["removed"]), lambda t: t["term"])
    columns = [col(c) for c in docs.columns]
    staged = found.select(
        *columns,
        body.alias(key),
        base_spans(body).alias(found_base),
        F.array_sort(F.transform(own, lambda t: t["term"])).alias(found_terms),
        removed.alias(found_removed),
    )
    apart = F.filter(
        _term_spans(F.col(key), F.col(found_terms)),
        lambda t: ~F.exists(found_base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    spanned = staged.withColumn(found_spans, F.array_sort(F.concat(found_base, apart)))
    text = _sanitised(F.col(key), F.col(found_spans), F.col(found_removed))
    return spanned.select(
        *columns,
        F.struct(F.col(found_base).alias("base"), F.col(found_spans).alias("spans"), text.alias("text")).alias(name),
    )


def count_of(spans: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*(F.lit(k) for k in (*KINDS, TERM)))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )
