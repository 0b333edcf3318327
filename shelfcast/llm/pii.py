"""Personal data: base spans by pattern, and terms that disclose them by information content (DataFrame functions only).

Base kinds are emails, addresses, card and phone numbers. Their values are the
protected entities. The words (runs of letters, of any length) in a window of
CONTEXT characters on either side of an entity are candidate terms; a word that the
window's outer edge cuts, or that lies in a base span, is none. Over all documents, with N rows, n(e)
holding entity e, n(t) holding term t and n(e, t) with t in e's window (repeated rows count each),

    PMI(e; t) = log2(N n(e, t) / (n(e) n(t))),    IC(e) = log2(N / n(e)),

and PMI / IC is the share of the entity's information that the term gives away.
At REMOVE or more a term is removed beside that entity, at GENERALISE or more it
is replaced by its general class; both need the pair in EVIDENCE different texts, so
mere copies of one document prove nothing. Counts are over the whole corpus. A term's class is what
most of its places beside entities show: organisation (a suffix such as GmbH is
or follows it), acronym (all capitals), name (capitalised), else word.

The patterns use possessive quantifiers and anchored starts: equal results to
the plain forms, in linear time and without deep recursion on long texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import fresh, ready, written

# Span kinds in the order of a digest, and the base patterns.
KINDS = ("email", "ip", "card", "phone", "term")
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
LABELS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")

# Organisation suffixes.
SUFFIX = "inc|ltd|llc|corp|corporation|company|gmbh|ag|plc|sarl|spa|foundation|university"

CONTEXT = 64
EVIDENCE = 2
GENERALISE, REMOVE = 0.5, 0.8
TERM = 4
SPAN = "struct<start:int,kind:int,end:int,value:string>"


def found(text: str, pattern: str, when: Column) -> tuple[Column, Column]:
    """All matches of a pattern in a column, and the text between them; empty where ``when`` fails."""
    none = F.array().cast("array<string>")
    return (F.when(when, F.regexp_extract_all(text, F.lit(pattern), 0)).otherwise(none),
            F.when(when, F.split(text, pattern, -1)).otherwise(none))


def placed(matches: str, gaps: str, kind: int, keep: Callable[[Column], Column], offset: Column | None = None) -> Column:
    """Spans of the matches that pass ``keep``: starts are running lengths of gaps and matches (code points)."""
    def length(parts: Column) -> Column:
        return F.aggregate(parts, F.lit(0), lambda a, p: a + F.length(p))

    def span(i: Column) -> Column:
        start = length(F.slice(gaps, F.lit(1), i)) + length(F.slice(matches, F.lit(1), i - 1))
        if offset is not None:
            start = start + offset
        value = F.element_at(matches, i)
        return F.struct(start.cast("int").alias("start"), F.lit(kind).alias("kind"),
                        (start + F.length(value)).cast("int").alias("end"), value.alias("value"))

    kept = F.filter(F.sequence(F.lit(1), F.size(matches)), lambda i: keep(F.element_at(matches, i)))
    return F.when(F.size(matches) > 0, F.transform(kept, span)).otherwise(F.array().cast(f"array<{SPAN}>"))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """The check sum of a digit string of at most 19 digits."""
    backward = F.reverse(value)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(backward, i, F.lit(1)).cast("int")
        doubled = F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
        return total + doubled

    return F.aggregate(F.sequence(F.lit(1), F.length(value)), F.lit(0), add) % 10 == 0


def is_card(value: Column) -> Column:
    number = digits(value)
    return F.when(F.length(number).between(14, 19), luhn(number)).otherwise(F.lit(False))


def base_spans(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep``, ``row`` (unique), a row key and ``spans`` (base kinds, sorted) of every document."""
    body = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("_text"),
                       F.monotonically_increasing_id().alias("row"), F.xxhash64("doc_id", "text").alias("row_key"))
    digit = F.col("_text").rlike("[0-9]")
    tests = ((EMAIL, F.contains("_text", F.lit("@"))), (IP, digit), (CARD, digit),
             (PHONE, F.contains("_text", F.lit("+"))))
    columns = []
    for kind, (pattern, when) in enumerate(tests):
        m, g = found("_text", pattern, when)
        columns += [m.alias(f"_m{kind}"), g.alias(f"_g{kind}")]
    matched = body.select("*", *columns)
    passes = (lambda v: F.lit(True), lambda v: v.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), is_card,
              lambda v: F.length(digits(v)).between(10, 15))
    spans = F.array_sort(F.concat(*[placed(f"_m{k}", f"_g{k}", k, passes[k]) for k in range(TERM)]))
    return matched.select(*keep, "row", "row_key", "_text", spans.alias("spans"))


def _contexts(span: Column) -> list[Column]:
    """(text, offset, cut) of the windows before and after a span; ``cut`` tells if the outer edge is inside the text."""
    start, end, text = span["start"], span["end"], F.col("_text")
    low = F.greatest(start - CONTEXT, F.lit(0))
    return [F.struct(F.substring(text, low + 1, start - low).alias("text"), low.alias("offset"),
                     (low > 0).alias("cut_left"), F.lit(False).alias("cut_right")),
            F.struct(F.substring(text, end + 1, F.lit(CONTEXT)).alias("text"), end.alias("offset"),
                     F.lit(False).alias("cut_left"), (F.length(text) > end + CONTEXT).alias("cut_right"))]


def entity(kind: Column, value: Column) -> Column:
    """A protected value: its kind and lower-cased text."""
    return F.concat(kind.cast("string"), F.lit(":"), F.lower(value))


def shape(value: Column, after: Column) -> Column:
    """What one place shows of a term's class."""
    organisation = F.lower(value).rlike(f"^(?:{SUFFIX})$") | after.rlike(rf"^[ ,.]{{1,2}}(?i:{SUFFIX})(?!\p{{L}})")
    return (F.when(organisation, "[ORGANISATION]").when(value.rlike(r"^\p{Lu}{2,}$"), "[ACRONYM]")
            .when(value.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]"))


def occurrences(found_spans: DataFrame) -> DataFrame:
    """(row, body, entity, term, start, end, shape): the words beside each entity, base spans left out."""
    entities = found_spans.select("row", "body", "spans", F.explode("near").alias("n")).select(
        "row", "body", "spans", entity(F.col("n.kind"), F.col("n.value")).alias("entity"), F.explode("n.windows").alias("w"))
    words, gaps = found("wtext", r"\p{L}+", F.lit(True))
    split = entities.select("*", F.col("w.text").alias("wtext")).select("*", words.alias("_m"), gaps.alias("_g"))
    spans = placed("_m", "_g", TERM, lambda v: F.lit(True), F.col("w.offset"))
    each = split.select("row", "body", "spans", "entity", "w", F.explode(spans).alias("s"))
    inside = ~(F.col("w.cut_left") & (F.col("s.start") == F.col("w.offset"))) & ~(
        F.col("w.cut_right") & (F.col("s.end") == F.col("w.offset") + CONTEXT))
    free = ~F.exists("spans", lambda b: (b["start"] < F.col("s.end")) & (b["end"] > F.col("s.start")))
    after = F.substring(F.col("w.text"), F.col("s.end") - F.col("w.offset") + 1, F.lit(16))
    return each.filter(inside & free).select("row", "body", "entity", F.lower("s.value").alias("term"),
                                             F.col("s.start").alias("start"), F.col("s.end").alias("end"),
                                             shape(F.col("s.value"), after).alias("shape"))


def disclosing(beside: DataFrame, held: DataFrame, docs: DataFrame, generalise: float = GENERALISE,
               evidence: int = EVIDENCE) -> DataFrame:
    """(entity, term, share) of the pairs whose share of disclosed information reaches ``generalise``.

    ``held`` has a row for each different entity of each document.
    """
    total = docs.count()
    pairs = (beside.groupBy("entity", "term").agg(F.countDistinct("row").alias("n_et"), F.countDistinct("body").alias("texts"))
             .filter(F.col("texts") >= evidence))
    entities = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    words = F.array_distinct(F.transform(F.split("text", r"\P{L}++"), F.lower))
    terms = docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    information = F.log2(F.lit(float(max(total, 1))) / F.col("n_e"))
    mutual = F.log2(F.lit(float(max(total, 1))) * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    scored = pairs.join(entities, "entity").join(terms, "term").withColumn(
        "share", F.when(information > 0, mutual / information).otherwise(F.lit(0.0)))
    return scored.filter(F.col("share") >= generalise).select("entity", "term", "share")


def classes(beside: DataFrame, told: DataFrame) -> DataFrame:
    """(term, class): what most places of a told term show; ties go to the first in alphabetical order."""
    counted = beside.join(told.select("term").distinct(), "term", "left_semi").groupBy("term", "shape").count()
    return counted.groupBy("term").agg(F.min(F.struct(-F.col("count"), F.col("shape"))).alias("b")).select(
        "term", F.col("b.shape").alias("class"))


def find(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep``, row_key and all spans (start, kind, end, value, action) of every document, sorted.

    ``action`` is what to put in place of a term: its class, or nothing if it is removed. A null text counts as empty and has no spans; repeated rows get the same
    spans; null ids are ordinary; an empty table gives an empty result.
    """
    ready(docs.sparkSession)
    based = base_spans(docs, *keep)
    near = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["value"].alias("value"),
                                                   F.array(*_contexts(s)).alias("windows")))
    body = F.xxhash64("_text").alias("body")
    based = written(based.select(*keep, "row", "row_key", body, "spans", near.alias("near")), "pii-base")
    holding = based.filter(F.size("spans") > 0)
    beside = written(occurrences(holding.select("row", "body", "spans", "near")), "pii-beside")
    values = F.array_distinct(F.transform("spans", lambda s: entity(s["kind"], s["value"])))
    told = written(disclosing(beside, holding.select(F.explode(values).alias("entity")), docs), "pii-told")
    terms = (beside.join(told, ["entity", "term"]).groupBy("row", "start", "end", "term").agg(F.max("share").alias("share"))
             .join(classes(beside, told), "term"))
    action = F.when(F.col("share") >= REMOVE, F.lit("")).otherwise(F.col("class"))
    terms = terms.groupBy("row").agg(F.collect_set(F.struct(
        "start", F.lit(TERM).alias("kind"), "end", F.col("term").alias("value"), action.alias("action"))).alias("terms"))
    joined = based.select(*keep, "row", "row_key", "spans").join(terms, "row", "left")
    base = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"),
                                                   s["end"].alias("end"), s["value"].alias("value"),
                                                   F.element_at(F.array(*map(F.lit, LABELS)), s["kind"] + 1).alias("action")))
    return joined.select(*keep, "row_key", F.array_sort(F.concat(base, F.coalesce(
        "terms", F.array().cast("array<struct<start:int,kind:int,end:int,value:string,action:string>>")))).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the count of each base kind, the digest of the base spans and all spans."""
    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    counts = [number(k) for k in range(TERM)]
    base = F.filter("spans", lambda s: s["kind"] != TERM)
    return find(docs, "doc_id").select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def sanitised_text(text: Column, spans: Column) -> Column:
    """The text with base spans replaced by labels, generalised terms by their class and removed terms left out."""
    def step(a: Column, s: Column) -> Column:
        new = s["start"] >= a["at"]                           # a span inside an earlier one is covered by it
        text_part = F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), s["action"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(new, text_part).otherwise(a["out"]).alias("out"))

    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts sanitised; rows, null texts and all other columns stay as they are."""
    key, marks = fresh(docs, "row_key"), fresh(docs, "spans")
    found_spans = find(docs, "doc_id").filter(F.size("spans") > 0).dropDuplicates(["row_key"])
    sent = written(found_spans.select(F.col("row_key").alias(key), F.col("spans").alias(marks)), "pii-spans")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text")).join(sent, key, "left")
    clean = F.when(F.col(marks).isNull(), F.col("text")).otherwise(sanitised_text(F.col("text"), F.col(marks)))
    return keyed.withColumn("text", clean).select(*docs.columns)
