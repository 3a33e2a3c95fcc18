"""Benchmark passages in training texts, found over a positional inverted index.

The index is sharded by text, and a long text by blocks of places: a shard
holds the postings of the terms that are asked for, their lists merged by
place. Every window of ten benchmark words is looked up from its rarest terms.
Their lists, each less its term's offset in the window, are intersected, for
all windows in one pass over a shard: two lists meet wherever two postings
stand as far apart as some window has these terms, give or take the slop. What
is left is compared with the text itself, word by word.

Rarity is counted over all training texts. Only postings of the rarest terms
are stored, and copies of one text are one shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm.shared import carried, given_back, within
from medloom.llm.text import alnum_words, cased_words, let, lowered_word, text_of
from medloom.sources.storage import materialize

WINDOW = 10
# Lists that are intersected for each window.
LISTS = 3
# One in so many terms of a window may be missing from a proximity match, two of ten.
ABSENT = 5
# Words by which a term of a proximity match may be off its place.
SLOP = 2
# Rows up to which a frame of short rows is broadcast, after it was counted; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
# The same for candidates, which carry the words of their window.
BROADCAST_CANDIDATES = 20_000
# The same for keys of texts, two longs each, and for pairs of terms, some 40 bytes each.
BROADCAST_KEYS = 1_000_000
# Places of a text in one shard of the index.
BLOCK = 4096


def _small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """The (written) frame, marked for a broadcast when its count allows it."""
    return F.broadcast(df) if df.count() <= (BROADCAST_ROWS if limit is None else limit) else df


def windows(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(wid, terms, items): distinct windows of the items with the keys of the items that have them.

    An item of fewer words is one window; one without words has none.
    """
    found = items.select(F.col(key).alias("item"), alnum_words(text_of(text)).alias("w")).filter(F.size("w") > 0)
    parts = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1))), lambda i: F.slice(F.col("w"), i, window))
    found = found.select("item", F.explode(parts).alias("terms"))
    found = found.groupBy("terms").agg(F.collect_set("item").alias("items"))
    return materialize(found.select(F.monotonically_increasing_id().alias("wid"), "terms", "items"), "windows")


def _keyed(df: DataFrame, text: str) -> DataFrame:
    """(k1, k2, pos, term): the terms of texts under a key of their content, 128 bits."""
    t = text_of(text)
    found = df.select(F.xxhash64(t).alias("k1"), F.xxhash64(t, F.lit(1)).alias("k2"), F.posexplode(cased_words(t)).alias("pos", "word"))
    return found.select("k1", "k2", "pos", lowered_word(F.col("word")).alias("term"))


def term_counts(df: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """(term, n): how often each of the terms stands in all texts."""
    found = df.select(F.explode(cased_words(text_of(text))).alias("word")).select(lowered_word(F.col("word")).alias("term"))
    return found.join(_small(terms), "term").groupBy("term").agg(F.count("*").alias("n"))


def plan(found: DataFrame, counts: DataFrame) -> DataFrame:
    """(wid, ranked): the terms of each window as (n, term, offset), rarest first; n is 0 where a term stands nowhere."""
    single = found.select("wid", F.posexplode("terms").alias("offset", "term")).join(counts, "term", "left")
    return single.groupBy("wid").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "offset"))).alias("ranked"))


def _coded(ranked: Column) -> Column:
    """(tid, offset) of ranked terms. A term goes by its hash; what two terms of one hash add is refuted by the text."""
    return F.transform(ranked, lambda t: F.struct(F.xxhash64(t["term"]).alias("tid"), t["offset"].cast("int").alias("offset")))


def exact_lookups(planned: DataFrame, lists: int = LISTS) -> DataFrame:
    """(wid, tid, offset, others, need): the rarest term of each window whose terms all occur, and the next rarest ones.

    All of them, ``need``, have to meet.
    """
    whole = planned.filter(F.col("ranked")[0]["n"] > 0)
    coded = whole.select("wid", _coded(F.slice("ranked", 1, lists)).alias("r"))
    return coded.select(
        "wid", F.col("r")[0]["tid"].alias("tid"), F.col("r")[0]["offset"].alias("offset"), F.slice("r", 2, lists).alias("others"),
        (F.size("r") - 1).alias("need"))


def _missing(size: Column) -> Column:
    return F.floor(size / ABSENT).cast("int")


def near_lookups(planned: DataFrame) -> DataFrame:
    """(wid, tid, offset, others, need) for proximity matches.

    Of one term more than may be missing, one is there: each of that many, the
    rarest, leads its window. Of two more, a second one is there as well,
    which ``others`` has. A term that stands nowhere is one that is missing.
    Exact occurrences are among these matches.
    """
    missing = _missing(F.size("ranked"))
    kept = planned.select("wid", missing.alias("m"), F.slice("ranked", 1, missing + 2).alias("ranked"))
    leads = kept.select("wid", "m", "ranked", F.posexplode("ranked").alias("rank", "t")).filter("rank <= m AND t.n > 0")
    others = _coded(F.filter("ranked", lambda o: o["offset"] != F.col("t.offset")))
    found = leads.select("wid", F.xxhash64("t.term").alias("tid"), F.col("t.offset").cast("int").alias("offset"), others.alias("others"))
    return found.withColumn("need", F.least(F.size("others"), F.lit(1)))


def asked_terms(planned: DataFrame, lists: int, near: bool) -> DataFrame:
    """(term): the terms to index."""
    most = _missing(F.size("ranked")) + 2 if near else F.lit(lists)
    terms = planned.select(F.explode(F.slice("ranked", F.lit(1), most)).alias("t"))
    return terms.filter("t.n > 0").select("t.term").distinct()


def postings(df: DataFrame, terms: DataFrame, reach: int, text: str = "text", block: int = BLOCK) -> DataFrame:
    """(k1, k2, block, postings): the index of all texts, in each shard the (pos, tid) of its lists merged by place.

    A shard repeats what follows it within ``reach``, so that postings meet
    across its border.
    """
    found = _keyed(df, text).join(_small(terms), "term").select("k1", "k2", "pos", F.xxhash64("term").alias("tid"))
    first = F.floor(F.greatest(F.col("pos") - reach, F.lit(0)) / block)
    found = found.withColumn("block", F.explode(F.sequence(first, F.floor(F.col("pos") / block))))
    found = found.groupBy("k1", "k2", "block").agg(F.sort_array(F.collect_set(F.struct("pos", "tid"))).alias("postings"))
    return found.withColumn("upto", (F.col("block") + 1) * block)


def _pairs(lookups: DataFrame, slop: int) -> DataFrame:
    """(wid, tid, offset, need, j, other, d): every distance at which the leading term of a window may meet its j-th other one."""
    each = lookups.select("wid", "tid", "offset", "need", F.posexplode_outer("others").alias("j", "other"))
    distance = F.col("other.offset") - F.col("offset")
    return each.withColumn("d", F.explode_outer(F.sequence(distance - slop, distance + slop)))


def _pair(first: Column, second: Column, distance: Column) -> Column:
    """Two terms and their distance as one key; what two pairs of one key add is refuted by the text."""
    return F.xxhash64(first, second, distance.cast("int"))


def candidates(index: DataFrame, lookups: DataFrame, reach: int, slop: int = 0) -> DataFrame:
    """(k1, k2, wid, starts): where a window may start in a text, as seen from a leading term.

    A start lies before the text where the first terms are cut off.
    """
    pairs = materialize(_pairs(lookups, slop), "window-pairs")
    # The same term may stand for two of a window; then, or without others, its own place is enough.
    alone = pairs.filter("other IS NULL OR (d = 0 AND other.tid = tid)").select("tid", "wid", "offset", "need", "j")
    ahead = F.col("d") > 0
    apart = pairs.filter("d <> 0").select(
        F.when(ahead, _pair(F.col("tid"), F.col("other.tid"), F.col("d")))
        .otherwise(_pair(F.col("other.tid"), F.col("tid"), -F.col("d"))).alias("pair"),
        "wid", "offset", "need", "j", ahead.alias("ahead"))

    def following(a, i):
        near = F.filter(F.slice("postings", i + 2, reach), lambda b: b["pos"] - a["pos"] <= reach)
        return F.transform(near, lambda b: F.struct(
            _pair(a["tid"], b["tid"], b["pos"] - a["pos"]).alias("pair"), a["pos"].alias("first"), b["pos"].alias("second")))
    own = F.filter("postings", lambda a: a["pos"] < F.col("upto"))
    met = index.select("k1", "k2", F.explode(F.flatten(F.transform(own, following))).alias("m"))
    met = met.select("k1", "k2", "m.*").join(_small(apart, BROADCAST_KEYS), "pair")
    met = met.withColumn("start", F.when(F.col("ahead"), F.col("first")).otherwise(F.col("second")) - F.col("offset"))
    single = index.select("k1", "k2", F.explode(own).alias("p")).select("k1", "k2", "p.*").join(_small(alone), "tid")
    single = single.withColumn("start", F.col("pos") - F.col("offset"))
    places = ["k1", "k2", "wid", "start", "need", "j"]
    # A window led by several terms may be seen from each; the others that met are counted for all of them alike.
    both = met.select(*places).unionByName(single.select(*places))
    bit = F.when(F.col("j").isNull(), F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("j")))
    both = both.groupBy("k1", "k2", "wid", "start", "need").agg(F.bit_or(bit).alias("bits")).filter(F.bit_count("bits") >= F.col("need"))
    return both.groupBy("k1", "k2", "wid").agg(F.sort_array(F.collect_set("start")).alias("starts"))


def _verified_near(w: Column, c: Column, slop: int) -> Column:
    """Starts of a window of whose terms enough stand within ``slop`` words of their places; all terms are looked at."""
    size = F.size(c["terms"])

    def there(start, term, i):
        low = F.greatest(start + i - slop, F.lit(0))
        return F.array_contains(F.slice(w, low + 1, F.greatest(start + i + slop - low + 1, F.lit(0))), term)

    def enough(start):
        return F.size(F.filter(c["terms"], lambda term, i: there(start, term, i))) >= size - F.floor(size / ABSENT)
    return F.filter(c["starts"], enough)


def _verified(w: Column, c: Column) -> Column:
    """Starts at which a window stands word by word."""
    return F.filter(c["starts"], lambda start: (start >= 0) & (
        F.slice(w, F.greatest(start, F.lit(0)) + 1, F.size(c["terms"])) == c["terms"]))


def _n_hit(spans: Column) -> Column:
    """Words within sorted spans; a word in several counts once."""
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))
    def step(held, span):
        end = span["start"] + span["size"]
        fresh = F.greatest(F.lit(0), end - F.greatest(span["start"], held["upto"]))
        return F.struct(F.greatest(held["upto"], end).alias("upto"), (held["n"] + fresh).alias("n"))
    return F.aggregate(spans, zero, step, lambda held: held["n"])


def _with_candidates(rows: DataFrame, by_text: DataFrame) -> DataFrame:
    """Rows (_k1, _k2, ...) with the candidates of their text.

    Few candidates are broadcast. Of more, the keys of their texts tell the
    rows that have any, and only those shuffle; beyond that all rows do.
    """
    same = (F.col("_k1") == F.col("_found_k1")) & (F.col("_k2") == F.col("_found_k2"))
    entries, texts = by_text.agg(F.sum(F.aggregate(
        "_found_windows", F.lit(0), lambda n, c: n + 1 + F.floor(F.size(c["starts"]) / 10).cast("int"))), F.count("*")).first()
    if (entries or 0) <= BROADCAST_CANDIDATES:
        return rows.join(F.broadcast(by_text), same, "left")
    if texts > BROADCAST_KEYS:
        return rows.join(by_text, same, "left")
    keys = F.broadcast(by_text.select("_found_k1", "_found_k2"))
    some = rows.join(keys, same, "left_semi").join(by_text, same, "left")
    return some.unionByName(rows.join(keys, same, "left_anti"), allowMissingColumns=True)


def decontaminate(
    df: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
    window: int = WINDOW, lists: int = LISTS, slop: int | None = None,
) -> DataFrame:
    """The frame with n_words, n_hit, items (keys), contaminated and, with ``slop``, n_near and near.

    A word is hit inside any occurrence of a window of an item. ``near`` has
    (start, items) of every place where at most one in ``ABSENT`` terms of a
    window is missing and all others stand within ``slop`` words of their
    places, as seen from one of its rarest terms; exact occurrences are
    included. ``n_near`` counts the windows of these places. Null and empty texts have no words, on
    either side; an item without a key hits words but is in no list. Repeated
    rows get equal results, and an empty table on either side gives zeros or
    no rows. Columns of the result's names in the frame are replaced.
    """
    columns, df, text = df.columns, carried(df), within(text)
    found = windows(items, item_key, item_text, window)
    terms = materialize(found.select(F.explode("terms").alias("term")).distinct(), "bench-terms")
    counts = materialize(term_counts(df, terms, text), "term-counts")
    planned = materialize(plan(found, counts), "window-plan")
    asked = materialize(asked_terms(planned, lists, slop is not None), "asked-terms")
    off = slop or 0
    reach = window - 1 + off
    lookups = materialize(exact_lookups(planned, lists) if slop is None else near_lookups(planned), "window-lookups")
    index = materialize(postings(df, asked, reach, text), "postings")
    places = materialize(candidates(index, lookups, reach, off), "candidates")
    by_text = places.join(_small(found), "wid").groupBy(F.col("k1").alias("_found_k1"), F.col("k2").alias("_found_k2")).agg(
        F.collect_list(F.struct("wid", "terms", "items", "starts")).alias("_found_windows"))
    t = text_of(text)
    rows = df.withColumns({"_k1": F.xxhash64(t), "_k2": F.xxhash64(t, F.lit(1))})
    by_text = materialize(by_text, "found-candidates")
    rows = _with_candidates(rows, by_text)
    held = F.coalesce(F.col("_found_windows"), F.array().cast(by_text.schema["_found_windows"].dataType))

    def judged(w):
        def seen(c):
            close = F.lit(None).cast("array<int>") if slop is None else _verified_near(w, c, off)
            return F.struct(F.size(c["terms"]).alias("size"), c["items"].alias("items"), _verified(w, c).alias("exact"), close.alias("near"))
        return F.struct(F.size(w).cast("long").alias("n_words"), F.transform(held, seen).alias("seen"))

    def places_of(kind, *fields):
        each = F.transform("_judged.seen", lambda c: F.transform(c[kind], lambda s: F.struct(s.alias("start"), *[c[f].alias(f) for f in fields])))
        return F.flatten(each)
    whole = F.filter("_judged.seen", lambda c: F.size(c["exact"]) > 0)
    # Without candidates the words are only counted.
    held_words = F.when(F.size(held) > 0, alnum_words(t)).otherwise(cased_words(t))
    rows = rows.withColumn("_judged", let(held_words, judged)).withColumns({
        "n_words": F.col("_judged.n_words"), "n_hit": _n_hit(F.sort_array(places_of("exact", "size"))),
        "items": F.array_distinct(F.flatten(F.transform(whole, lambda c: c["items"]))),
        "contaminated": F.size(whole) > 0,
    })
    if slop is not None:
        # By start; what starts at one place is in order of its keys.
        rows = rows.withColumns({
            "n_near": F.size(F.filter("_judged.seen", lambda c: F.size(c["near"]) > 0)).cast("long"),
            "near": F.sort_array(places_of("near", "items")),
        })
    return given_back(rows.drop("_judged", "_k1", "_k2", *by_text.columns), columns)


_SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPLIT}'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPLIT}'), lambda x: x <> '') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[p + 1 : p + {WINDOW}], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - {WINDOW - 1}, 1))) AS p FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, p, n, array_to_string(w[p + 1 : p + n], ' ') AS k
  FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS p FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT r, p, dw.n, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n),
words AS (SELECT r, count(DISTINCT p + i) AS c FROM hits, range({WINDOW}) x(i) WHERE i < n GROUP BY r),
found AS (
  SELECT r, count(*) AS c, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY r),
grams AS (
  SELECT row_number() OVER () AS wid, ts, len(ts) AS n, len(ts) // {ABSENT} AS m
  FROM (SELECT DISTINCT w[p + 1 : p + {WINDOW}] AS ts FROM (SELECT w, unnest(range(greatest(len(w) - {WINDOW - 1}, 1))) AS p FROM b WHERE len(w) > 0))),
gram_terms AS (SELECT wid, m, unnest(ts) AS x, unnest(range(n)) AS o FROM grams),
flat AS (SELECT r, unnest(w) AS x, unnest(range(len(w))) AS p FROM d),
counts AS (SELECT x, count(*) AS c FROM flat WHERE x IN (SELECT x FROM gram_terms) GROUP BY x),
leads AS (
  SELECT wid, x, o FROM (
    SELECT wid, m, gram_terms.x, o, c, row_number() OVER (PARTITION BY wid ORDER BY coalesce(c, 0), gram_terms.x, o) AS k
    FROM gram_terms LEFT JOIN counts ON gram_terms.x = counts.x)
  WHERE k <= m + 1 AND c > 0),
may AS (SELECT DISTINCT r, wid, p - o AS s FROM flat JOIN leads ON flat.x = leads.x),
near AS (
  SELECT may.r, may.wid FROM may JOIN d ON may.r = d.r JOIN grams ON may.wid = grams.wid
  WHERE len(list_filter(range(n), lambda i: list_contains(w[greatest(s + i - {SLOP}, 0) + 1 : greatest(s + i + {SLOP} + 1, 0)], ts[i + 1]))) >= n - m),
close AS (SELECT r, count(DISTINCT wid) AS c, count(*) AS places FROM near GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.c, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(found.c, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(words.c, 0) > 0 AS contaminated, CAST(coalesce(close.c, 0) AS BIGINT) AS n_near, CAST(coalesce(places, 0) AS BIGINT) AS n_near_places
FROM d LEFT JOIN words ON d.r = words.r LEFT JOIN found ON d.r = found.r LEFT JOIN close ON d.r = close.r
"""
