"""Personal data: base patterns, and terms that reveal a protected value by how they occur with it in the corpus."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmart.llm.common import KEY, matches, text_key, text_of, written

DISCLOSURE = 0.9     # share of a value's information that a term may give away
DOCUMENTS = 3        # in fewer documents together, a term and a value tell nothing
PUBLIC_SHARE = 0.01  # values in more documents than this share are public
LABELS = ("email", "ip", "card", "phone", "general", "removed")  # the order of equal starts
STEM = 3             # characters that a generalised term keeps
_SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the last of 12 to 19 digits is right by Luhn's rule."""
    def part(i: Column) -> Column:
        digit = F.ascii(F.substr(digits, F.length(digits) - i, F.lit(1))) - 48
        doubled = digit * 2
        return F.when(i % 2 == 0, digit).when(doubled > 9, doubled - 9).otherwise(doubled)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + part(i))
    return F.length(digits).between(12, 19) & F.when(F.length(digits).between(12, 19), total % 10 == 0).otherwise(False)


@dataclass(frozen=True)
class Kind:
    """Leftmost matches of ``pattern`` that do not overlap; ``valid`` drops some; ``value`` names what is protected.
    ``guard`` is true for all texts with a match and cheap."""

    name: str
    pattern: str
    guard: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    value: Callable[[Column], Column]


# The contract's patterns. Runs are taken possessively and begun at their first character only, which finds the same
# matches in linear time and without recursion.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda text: text.contains("@"), lambda hit: F.lit(True), F.lower),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda text: text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
         lambda hit: hit.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"), lambda hit: hit),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", lambda text: text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"),
         lambda hit: _luhn(_digits(hit)), _digits),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda text: text.contains("+"),
         lambda hit: F.length(_digits(hit)).between(9, 15), _digits),
)


def spans(text: Column, kind: Kind) -> Column:
    """The kind's findings in code points, end exclusive."""
    found = F.filter(matches(text, kind.pattern), lambda m: kind.valid(m["hit"]))
    named = F.transform(found, lambda m: F.struct(F.lit(kind.name).alias("kind"), m["start"].alias("start"),
                                                  m["end"].alias("end"), kind.value(m["hit"]).alias("value")))
    return F.when(kind.guard(text), named).otherwise(F.expr(f"cast(array() as {_SPANS})"))


def find_values(docs: DataFrame) -> DataFrame:
    """doc_id, key of the text, base (spans of KINDS) of every row, and the text of rows that have some."""
    text = text_of()
    rows = docs.select("doc_id", *text_key(), text.alias("text")).withColumn(
        "base", F.concat(*(spans(F.col("text"), kind) for kind in KINDS)))
    return rows.select("doc_id", *KEY, "base", F.when(F.size("base") > 0, F.col("text")).alias("text"))


_TERM = r"[\p{L}\p{N}]+"


def _general(term: Column) -> Column:
    """What a term is generalised to: its first characters, with digits as 0."""
    return F.concat(F.regexp_replace(F.left(term, F.lit(STEM)), r"\p{N}", "0"), F.lit("*"))


def _codes(term: Column) -> Column:
    return F.xxhash64(term)


def document_counts(docs: DataFrame) -> DataFrame:
    """(code, documents): in how many rows of ``docs`` each term and each general form stands, by its hash. Tasks count
    ahead of the shuffle, so a frequent term moves one row a task."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text_of()), F.lit(_TERM), F.lit(0)))
    codes = F.concat(F.transform("words", _codes), F.array_distinct(F.transform("words", lambda w: _codes(_general(w)))))
    return (docs.select(words.alias("words")).select(F.explode(codes).alias("code"))
            .groupBy("code").agg(F.count(F.lit(1)).alias("documents")))


def terms_outside(holders: DataFrame) -> DataFrame:
    """(key, start, end, term) of the terms of ``holders`` (key, text, base) that no base span touches. Positions are
    running sums over the terms of a text and spans are met in order of position, so long texts cost no more
    than their sort."""
    zipped = F.arrays_zip(
        F.transform(F.split("text", _TERM, -1), lambda x: F.length(x)).alias("gap"),
        F.regexp_extract_all("text", F.lit(_TERM), F.lit(0)).alias("hit"))
    hit, upto = F.col("t.hit"), Window.partitionBy(*KEY).orderBy("no")
    end = F.sum(F.col("t.gap") + F.length(hit)).over(upto)
    terms = (holders.select(*KEY, F.posexplode(zipped).alias("no", "t")).where(hit.isNotNull())
             .select(*KEY, (end - F.length(hit)).cast("int").alias("start"), end.cast("int").alias("end"), F.lower(hit).alias("term")))
    taken = (holders.select(*KEY, F.explode("base").alias("b"))
             .select(*KEY, "b.start", "b.end", F.lit(None).cast("string").alias("term")))
    along = Window.partitionBy(*KEY).orderBy("start", F.col("term").isNotNull())
    covered = F.max(F.when(F.col("term").isNull(), F.col("end"))).over(along.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(F.when(F.col("term").isNull(), F.col("start")), ignorenulls=True).over(
        along.rowsBetween(1, Window.unboundedFollowing))
    met = terms.union(taken).withColumn("covered", covered).withColumn("ahead", ahead)
    free = (F.coalesce("covered", F.lit(0)) <= F.col("start")) & F.coalesce(F.col("ahead") >= F.col("end"), F.lit(True))
    return met.where(F.col("term").isNotNull() & free).drop("covered", "ahead")


def _disclosed(together: Column, term: Column, value: Column, total: int) -> Column:
    """Pointwise mutual information of a term and a value as a share of the value's information: 1 if all documents with the
    term hold the value, null for a value that all documents hold, which has none."""
    return 1 - F.ln(term / together) / F.nullif(F.ln(F.lit(float(total)) / value), F.lit(0.0))


def _set_of_texts() -> list[Column]:
    """128 bits that stand for a set of different texts."""
    return [F.bit_xor(F.xxhash64(F.lit(salt), *KEY)).alias(name) for salt, name in ((1, "set_a"), (2, "set_b"))]


def revealing_terms(docs: DataFrame, found: DataFrame, disclosure: float = DISCLOSURE, least: int = DOCUMENTS,
                    public: float = PUBLIC_SHARE) -> DataFrame:
    """(key, kind, start, end) of the terms that reveal a protected value of their own text.

    ``found`` is the written result of find_values. A value is protected if it stands in ``least`` documents or more and in
    at most the share ``public`` of all. A term outside all base spans reveals it if both stand together in
    ``least`` documents and the term gives ``disclosure`` or more of the value's information away: PMI / -log p(value). It is
    generalised to its first three characters where that form reveals none of these values, else removed. With a
    share of 1 values of any frequency are protected; the work is then still in proportion to the values and terms that
    stand in one text together.

    Values that stand in the same texts are one class, and so are terms; only classes meet, and only where the
    counts allow disclosure, so a list of addresses that is kept in several versions does not pair each address with each
    word. All counts are of documents.
    """
    total = found.count()
    holders = written(found.where(F.size("base") > 0).groupBy(*KEY).agg(
        F.any_value("text").alias("text"), F.any_value("base").alias("base"), F.count(F.lit(1)).alias("copies")), "holders")
    names = F.array_distinct(F.transform("base", lambda s: F.concat(s["kind"], F.lit(" "), s["value"])))
    values = holders.select(*KEY, "copies", F.explode(names).alias("value"))
    classes = (values.groupBy("value").agg(F.sum("copies").alias("df"), *_set_of_texts())
               .where((F.col("df") >= least) & (F.col("df") <= public * total)))
    held = written(values.join(classes, "value").select(
        *KEY, "copies", F.col("set_a").alias("value_a"), F.col("set_b").alias("value_b"), "df",
        # documents that a term may stand in to disclose this value
        (F.col("df") * F.pow(F.lit(float(max(total, 1))) / F.col("df"), F.lit(1 - disclosure)) * 1.000001).alias("reach"))
        .distinct(), "held")
    widest = held.agg(F.max("reach")).first()[0] or 0.0

    places = written(terms_outside(holders.join(held.select(*KEY).distinct(), KEY, "left_semi"))
                     .withColumn("code", _codes(F.col("term"))).withColumn("general", _codes(_general(F.col("term"))))
                     .withColumn("shortens", F.length("term") > STEM).drop("term"), "places")
    terms = places.groupBy(*KEY, "code").agg(F.any_value("general").alias("general"), F.any_value("shortens").alias("shortens"))
    seen = places.select("code").union(places.select("general")).distinct()
    # an inner join stays behind the aggregate; a semi join would be moved ahead of it, to every word of every document
    counts = written(document_counts(docs).join(seen, "code"), "counts")

    rare = terms.join(counts.where(F.col("documents") <= widest), "code")
    sets = rare.groupBy("code").agg(*_set_of_texts())
    grouped = written(rare.join(sets, "code").select(*KEY, "code", "general", "shortens", "documents", "set_a", "set_b"), "terms")
    term_classes = grouped.select(*KEY, "set_a", "set_b", "documents").distinct()
    value, term = ["value_a", "value_b"], ["set_a", "set_b", "documents"]
    meet = held.join(term_classes, KEY).where(F.col("documents") <= F.col("reach"))
    reveals = (meet.groupBy(*value, *term, "df").agg(F.sum("copies").alias("together"))
               .where((F.col("together") >= least)
                      & (_disclosed(F.col("together"), F.col("documents"), F.col("df"), total) >= disclosure)))
    reveals = written(reveals, "reveals")

    # values meet terms by text: a value in many texts, with many terms of its own, would otherwise pair all of them
    flagged = (held.join(grouped, KEY).where(F.col("documents") <= F.col("reach")).join(reveals.select(*value, *term), [*value, *term])
               .select(*KEY, *value, "df", "code", "general", "shortens").distinct())
    flagged = written(flagged, "flagged")
    forms = flagged.where("shortens").select(*value, "df", "general").distinct()
    within = terms.select(*KEY, "general").distinct()
    open_forms = (held.select(*KEY, "copies", *value).join(forms.select(*value).distinct(), value, "left_semi")
                  .join(within, KEY).join(forms, [*value, "general"])
                  .groupBy(*value, "df", "general").agg(F.sum("copies").alias("together"))
                  .join(counts.withColumnRenamed("code", "general"), "general")
                  .select(*value, "general", (_disclosed(F.col("together"), F.col("documents"), F.col("df"), total)
                                              < disclosure).alias("safe")))
    acts = (flagged.join(open_forms, [*value, "general"], "left").groupBy(*KEY, "code")
            .agg(F.bool_and(F.col("shortens") & F.coalesce("safe", F.lit(False))).alias("keeps")))
    return places.join(acts, [*KEY, "code"]).select(
        *KEY, F.when(F.col("keeps"), "general").otherwise("removed").alias("kind"), "start", "end")


def span_text(found: Column) -> Column:
    """kind:start:end of all spans, ordered by start, then kind as in LABELS, joined by commas."""
    ranked = F.array_sort(F.transform(found, lambda s: F.struct(
        s["start"], F.array_position(F.array(*map(F.lit, LABELS)), s["kind"]).alias("rank"), s["end"], s["kind"])))
    return F.concat_ws(",", F.transform(ranked, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def _with_spans(docs: DataFrame, disclosure: float, least: int, public: float) -> DataFrame:
    """doc_id, key of the text, base and added spans of every row."""
    found = written(find_values(docs), "found")
    kinds = "array<struct<kind:string,start:int,end:int>>"
    added = written(revealing_terms(docs, found, disclosure, least, public).groupBy(*KEY).agg(
        F.collect_list(F.struct("kind", "start", "end")).alias("added")), "added")
    base = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return (found.join(added, KEY, "left")
            .select("doc_id", *KEY, base.alias("base"), F.coalesce("added", F.expr(f"cast(array() as {kinds})")).alias("added")))


def find_disclosures(docs: DataFrame, disclosure: float = DISCLOSURE, least: int = DOCUMENTS,
                     public: float = PUBLIC_SHARE) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row of ``docs``.

    ``spans`` holds the base findings and the terms of revealing_terms as kinds ``general`` and ``removed``, which lie
    outside base findings and stand only in texts that hold a protected value, so texts without personal
    data have none. Whole texts are searched, in time linear in their length; null and empty texts have no findings;
    null ids stay null; repeated rows count each as a document and are all returned; further columns are ignored; an
    empty table gives no rows. Built-in expressions only.
    """
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return _with_spans(docs, disclosure, least, public).select(
        "doc_id", *(count(k.name).alias(f"n_{k.name}") for k in KINDS),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.concat("base", "added")).alias("spans"))


def sanitise(docs: DataFrame, disclosure: float = DISCLOSURE, least: int = DOCUMENTS, public: float = PUBLIC_SHARE) -> DataFrame:
    """``docs`` with all their columns and personal data taken out of ``text``: base findings become ``[email]`` and so on,
    general terms their first three characters and ``*``, removed ones ``[removed]``. Of findings that overlap the
    first stands for what it covers. Null texts stay null; repeated rows are alike."""
    cut = (_with_spans(docs, disclosure, least, public).where(F.size("base") > 0).groupBy(*KEY)
           .agg(F.any_value(F.concat("base", "added")).alias("cuts"))
           .select(F.col("key_a").alias("cut_a"), F.col("key_b").alias("cut_b"), "cuts"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), *text_key())
    text = F.col("row.text")
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        kept = F.substr(text, acc["at"] + 1, s["start"] - acc["at"])
        stem = F.concat(F.regexp_replace(F.substr(text, s["start"] + 1, F.lit(STEM)), r"\p{N}", "0"), F.lit("*"))
        label = F.when(s["kind"] == "general", stem).otherwise(F.concat(F.lit("["), s["kind"], F.lit("]")))
        over = s["start"] < acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(over, acc["parts"]).otherwise(F.concat(acc["parts"], F.array(kept, label))).alias("parts"))

    ordered = F.array_sort(F.transform("cuts", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["end"].alias("end"), s["kind"].alias("kind"))))
    clean = F.aggregate(ordered, start, step, lambda acc: F.concat(
        F.array_join(acc["parts"], ""), F.substr(text, acc["at"] + 1, F.length(text))))
    joined = rows.join(cut, (F.col("key_a") == F.col("cut_a")) & (F.col("key_b") == F.col("cut_b")), "left")
    new = F.when(F.col("cuts").isNull(), text).otherwise(clean)
    return joined.select(*(new.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))
