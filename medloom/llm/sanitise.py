r"""Personal data, and the terms in the same text that would give it away.

Addresses and numbers are found by pattern. The corpus then says how strongly
a term reveals a protected entity (an exact address or number): with N
distinct texts, PMI(t; e) = log(N * c(t, e) / (c(t) * c(e))) is compared with
all there is to know, IC(e) = log(N / c(e)). A term whose share of it reaches
``DISCLOSURE`` is generalised, one that reaches ``IDENTIFYING`` is removed,
wherever it stands in the texts that hold the entity. Common words share next
to nothing with any entity and stay.

Copies of a text count once. Every entity is judged from its first text on,
and little evidence counts less: the share of a pair seen in c(t, e) texts is
taken times c(t, e) / (c(t, e) + ``DOUBT``), whatever the size of the corpus. So
one text is enough only for a term that stands in no other text, which is
generalised; of two texts on a few others may hold the term, and a term is
removed from five texts on.
"""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.llm.shared import carried, given_back, within
from medloom.llm.text import alnum_words, text_of
from medloom.sources.storage import materialize

KINDS = ("email", "ip", "card", "phone")
DISCLOSURE = 0.8
IDENTIFYING = 0.95
# Texts without the entity that stand against those with it.
DOUBT = 0.25
# Rows up to which a frame of short rows is broadcast, after it was counted; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
# The same for keys of texts, two longs each, and for the terms that texts are to lose.
BROADCAST_KEYS = BROADCAST_TERMS = 1_000_000
# Parts the copies of a text are dealt over where terms and texts meet in a shuffle.
SALTS = 16

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses; every one has its own @, so each is looked at from there."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        start = at
        if domain:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
        if domain and start < at:
            found.append((start, domain.end()))
            done = domain.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _small_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed; positions are code points."""
    if not text:
        return []
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _small_parts(m.group())]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    found.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                    found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _entity(kind: str, value: str) -> str:
    return f"{kind}:{value.translate(_UPPER)}" if kind in ("email", "ip") else f"{kind}:" + re.sub("[^0-9]", "", value)


def _outside(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(term, start, end) of all terms outside of the spans, which are in order of their start."""
    lowered, done, found = text.translate(_UPPER), 0, []
    for start, end in [(a, b) for _, a, b in spans] + [(len(text), len(text))]:
        if start > done:
            found += [(m.group(), m.start() + done, m.end() + done) for m in _TERM.finditer(lowered[done:start])]
        done = max(done, end)
    return found


def _entity_texts(df: DataFrame, text: str) -> DataFrame:
    """(k1, k2, entities, terms): each distinct text with an entity, with its distinct terms."""
    def run(batches):
        for batch in batches:
            rows = []
            for a, b, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                spans = base_spans(value)
                if spans:
                    rows.append((a, b, sorted({_entity(k, value[s:e]) for k, s, e in spans}), sorted({t for t, _, _ in _outside(value, spans)})))
            columns = list(zip(*rows)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["k1", "k2", "entities", "terms"])

    t = text_of(text)
    keyed = df.select(F.xxhash64(t).alias("k1"), F.xxhash64(t, F.lit(1)).alias("k2"), t.alias("t"))
    found = keyed.mapInArrow(run, "k1 long, k2 long, entities array<string>, terms array<string>")
    return found.groupBy("k1", "k2").agg(F.first("entities").alias("entities"), F.first("terms").alias("terms"))


def co_occurrences(df: DataFrame, text: str = "text") -> DataFrame:
    """(k1, k2, entity, term): what stands in a text with each entity, once for each distinct text; an entity alone has a null term."""
    return _paired(materialize(_entity_texts(df, text), "entity-texts"))


def _paired(found: DataFrame) -> DataFrame:
    each = found.select("k1", "k2", "terms", F.explode("entities").alias("entity"))
    alone = F.array(F.lit(None).cast("string"))
    return each.select("k1", "k2", "entity", F.explode(F.concat(alone, "terms")).alias("term"))


def _small(df: DataFrame, limit: int | None = None) -> DataFrame:
    return F.broadcast(df) if df.count() <= (BROADCAST_ROWS if limit is None else limit) else df


def _judged(
    df: DataFrame, pairs: DataFrame, text: str, threshold: float, doubt: float, texts: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(entity, term, share) from ``threshold`` on, and (k1, k2, entity, term) of all pairs that may be among them.

    ``texts``, where at hand, is what the pairs were made from.
    """
    t = text_of(text)
    keyed = [F.xxhash64(t).alias("k1"), F.xxhash64(t, F.lit(1)).alias("k2")]
    entities = materialize(pairs.filter("term IS NULL").groupBy("entity").agg(F.count("*").alias("c_e")), "entities")
    each = pairs.filter("term IS NOT NULL") if texts is None else texts.select(F.explode("terms").alias("term"))
    terms = materialize(each.select("term").distinct(), "candidate-terms")
    if not terms.take(1):
        return pairs.select("entity", "term", F.lit(0.0).alias("share")).limit(0), pairs.limit(0)
    copies = materialize(df.select(*keyed).groupBy("k1", "k2").agg(F.count("*").alias("n")), "text-copies")
    total = copies.count()
    repeated = materialize(copies.filter("n > 1"), "repeated-texts")
    # The n copies of a text count 1/n each, which adds up to whole texts without bringing the copies together.
    stands = df.select(*keyed, F.array_distinct(alnum_words(t)).alias("w")).join(_small(repeated, BROADCAST_KEYS), ["k1", "k2"], "left")
    stands = stands.select((1 / F.coalesce("n", F.lit(1))).alias("part"), F.explode("w").alias("term"))
    stands = stands.groupBy("term").agg(F.round(F.sum("part")).cast("long").alias("c_t"))
    # A piece of a word that a span cuts may stand in no text as a word.
    stands = terms.join(stands, "term", "left").select("term", F.coalesce("c_t", F.lit(0)).alias("c_t"))
    stands = materialize(stands, "term-texts")
    n = F.lit(float(total))
    information = F.log(n / F.col("c_e"))
    # No pair stands in more texts than its term or its entity, which bounds its share.
    most_texts = F.greatest(F.least("c_t", "c_e"), F.lit(1))
    bound = F.log(n / F.greatest("c_t", "c_e")) * most_texts / (most_texts + doubt) >= threshold * information - 1e-9
    most = entities.agg(F.max("c_e")).first()[0]
    rare = materialize(stands.withColumn("c_e", F.lit(most)).filter(bound).drop("c_e"), "rare-terms")
    # A text's terms meet their counts once, not once for each entity.
    found = pairs.filter("term IS NOT NULL").select("k1", "k2", "term").distinct() if texts is None else texts.select("k1", "k2", F.explode("terms").alias("term"))
    holders = materialize(pairs.filter("term IS NULL").select("k1", "k2", "entity").join(_small(entities), "entity"), "entity-holders")
    rare = found.join(rare, "term").join(_small(holders), ["k1", "k2"]).filter(bound)
    rare = materialize(rare.select("k1", "k2", "entity", "term", "c_e", "c_t"), "pairs-rare")
    known = rare.groupBy("entity", "term", "c_e", "c_t").agg(F.count("*").alias("c_te"))
    shared = F.log(n * F.col("c_te") / (F.greatest("c_t", "c_te") * F.col("c_e"))) * F.col("c_te") / (F.col("c_te") + doubt)
    # An entity that stands in every text has nothing to disclose.
    known = known.withColumn("share", F.when(information > 0, shared / information).otherwise(F.lit(0.0)))
    known = materialize(known.filter(F.col("share") >= threshold - 1e-9).select("entity", "term", "share"), "disclosures")
    return known, rare.select("k1", "k2", "entity", "term")


def disclosures(
    df: DataFrame, pairs: DataFrame, text: str = "text", threshold: float = DISCLOSURE, doubt: float = DOUBT,
) -> DataFrame:
    """(entity, term, share): pairs whose term gives away at least ``threshold`` of the entity."""
    return _judged(df, pairs, text, threshold, doubt)[0]


@F.pandas_udf(_SPANS)
def _spans(texts: pd.Series, general: pd.Series, removed: pd.Series) -> pd.Series:
    out = []
    for text, some, all_of in zip(texts, general, removed):
        found = base_spans(text)
        if found and some is not None:
            marks = dict.fromkeys(some, "general") | dict.fromkeys(all_of, "removed")
            terms = [(marks[t], a, b) for t, a, b in _outside(text, found) if t in marks]
            found = sorted(found + terms, key=lambda s: (s[1], (*KINDS, "general", "removed").index(s[0])))
        out.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
    return pd.Series(out)


def _with_revealed(rows: DataFrame, revealed: DataFrame) -> DataFrame:
    """Rows (_k1, _k2, ...) with the terms their text is to lose.

    Few terms are broadcast. Of more, the keys of their texts tell the rows
    that have any, and only those shuffle, the copies of a text over
    ``SALTS`` parts; beyond that all rows do.
    """
    same = (F.col("_k1") == F.col("_r1")) & (F.col("_k2") == F.col("_r2"))
    terms, texts = revealed.agg(F.sum(F.size("_general") + F.size("_removed")), F.count("*")).first()
    if (terms or 0) <= BROADCAST_TERMS:
        return rows.join(F.broadcast(revealed), same, "left")
    salted = revealed.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    met = same & (F.col("_salt") == F.col("_part"))
    if texts > BROADCAST_KEYS:
        return dealt.join(salted, met, "left").drop("_salt", "_part")
    keys = F.broadcast(revealed.select("_r1", "_r2"))
    some = dealt.join(keys, same, "left_semi").join(salted, met, "left").drop("_salt", "_part")
    return some.unionByName(rows.join(keys, same, "left_anti"), allowMissingColumns=True)


@F.pandas_udf(T.StringType())
def masked(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts with their spans replaced: base kinds by their name, terms by a general word or by nothing."""
    out = []
    for text, found in zip(texts, spans):
        if found is None or not len(found):
            out.append(text)
            continue
        parts, done = [], 0
        for span in sorted(found, key=lambda s: s["start"]):
            if span["start"] >= done:
                word = text[span["start"]:span["end"]]
                general = "[NUMBER]" if word[:1].isdigit() else "[NAME]" if word[:1].isupper() else "[TERM]"
                name = {"general": general, "removed": ""}.get(span["kind"], f"[{span['kind'].upper()}]")
                parts += [text[done:span["start"]], name]
            done = max(done, span["end"])
        out.append("".join(parts) + text[done:])
    return pd.Series(out)


def sanitise(
    df: DataFrame, text: str = "text", threshold: float = DISCLOSURE, identifying: float = IDENTIFYING,
    doubt: float = DOUBT,
) -> DataFrame:
    """The frame with ``spans``: array of (kind, start, end), end exclusive, by start and kind.

    Kinds are email, ip, card and phone, and ``general`` or ``removed`` for
    terms that disclose one of them, at every place of the text; ``masked``
    applies the spans. A null or empty text has none. Texts without an entity
    never change. Repeated rows get equal spans and count once as evidence. An
    empty table gives an empty result; a column named spans is replaced.
    """
    columns, df, text = df.columns, carried(df), within(text)
    texts = materialize(_entity_texts(df, text), "entity-texts")
    known, rare = _judged(df, _paired(texts), text, threshold, doubt, texts)
    found = rare.join(known, ["entity", "term"])
    strong = F.col("share") >= identifying - 1e-9
    # A term that several entities of a text ask for is removed if one of them asks for it; see _spans.
    revealed = found.groupBy(F.col("k1").alias("_r1"), F.col("k2").alias("_r2")).agg(
        F.collect_set(F.when(~strong, F.col("term"))).alias("_general"), F.collect_set(F.when(strong, F.col("term"))).alias("_removed"))
    revealed = materialize(revealed, "revealed")
    t = text_of(text)
    rows = df.withColumns({"_k1": F.xxhash64(t), "_k2": F.xxhash64(t, F.lit(1))})
    rows = _with_revealed(rows, revealed)
    rows = rows.withColumn("spans", _spans(t, F.col("_general"), F.col("_removed")))
    return given_back(rows.drop("_k1", "_k2", "_r1", "_r2", "_general", "_removed"), columns)


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*KINDS))


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def as_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
