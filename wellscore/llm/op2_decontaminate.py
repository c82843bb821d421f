"""Benchmark decontamination by template canonicalisation (DataFrame operations only).

Both sides become words: runs of letters and numbers, lower case; "48kg" is two words, and a
number keeps its marks ("3.5", "1,000"). A number or number word is the placeholder number, a
title-case word is a name wherever it stands unless it is one of the listed function words, a
word of the unit list is a unit. Windows of W template words are hashed and hash-joined;
windows with fewer than half literal words say too little and aren't used. For matched windows
with placeholders the slots must be one-to-one: within a document, item text and alignment
(position in the document less position in the item), each benchmark value stands for one
document value and each document value for one benchmark value ("1,000" and "1000", "twelve"
and "12" are the same value, 3.5 and 35 aren't). A clash in one alignment leaves the others as
they are.

A document is contaminated by an item if at least min(min_windows, all usable windows of the
item) distinct windows of it are found. An item shorter than W words is one window of its
own length.

The benchmark's window table is broadcast only while it has at most `broadcast_rows` rows;
beyond that the join shuffles by window hash. Documents are never collected per window.

Edge cases: null texts have no words; a null doc_id is a value like any other; repeated rows
get the same verdict each; an empty benchmark leaves all documents clean; extra columns are
ignored (contaminated) or passed through (decontaminate).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellscore.llm.common import table_rows, written

WINDOW, MIN_WINDOWS = 8, 6
# Unit words
UNITS = "kg g mg lb lbs oz t km m cm mm mi ft in yd l ml cl dl gal s sec ms min h hr hrs hours minutes seconds days weeks months years usd eur gbp dollars euros pounds cents percent mph kmh w kw kwh v a hz khz mhz ghz kb mb gb tb".split()
# Number words
NUMBERS = {w: str(n) for n, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split())}
NUMBERS |= {"thirty": "30", "forty": "40", "fifty": "50", "sixty": "60", "seventy": "70", "eighty": "80", "ninety": "90", "hundred": "100", "thousand": "1000", "million": "1000000"}
# Function words that are no names when they open a sentence
OPENERS = (
    "a an the this that these those there here it its he she we you they his her our your their my each every all some any no both after before at by for from in of on to with "
    "during since until while when where why who whom whose which what how if then so but and or nor as because although is are was were do does did has have had can could will would "
    "should may might must let find give given calculate compute write name not now today yesterday tomorrow"
).split()
NAME = "\u0001"


def words(text: Column) -> Column:
    """Words in order; a title-case word keeps the mark before it."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"(^|[^\p{L}\p{N}])(\p{Lu}\p{Ll})", f"$1{NAME}$2")
    return F.regexp_extract_all(F.lower(t), F.lit(rf"{NAME}?\p{{L}}+|\p{{N}}+(?:[.,]\p{{N}}+)*"), F.lit(0))


def template(w: Column) -> Column:
    head, bare = F.substring(w, 1, 1), F.ltrim(w, F.lit(NAME))
    kind = F.when(head.between("0", "9") | bare.isin(list(NUMBERS)), "<number>").when(head != NAME, F.when(w.isin(UNITS), "<unit>").otherwise(w))
    return kind.otherwise(F.when(bare.isin(OPENERS), bare).otherwise("<name>"))


def value(w: Column) -> Column:
    """What the word of a slot stands for, however it is written."""
    bare = F.ltrim(w, F.lit(NAME))
    digits = F.when(w.rlike(r"^[0-9]{1,3}(,[0-9]{3})+(\.[0-9]+)?$"), F.replace(w, F.lit(","))).otherwise(F.replace(w, F.lit(","), F.lit(".")))
    said = F.element_at(F.create_map(*[F.lit(x) for kv in NUMBERS.items() for x in kv]), bare)
    return F.coalesce(said, digits)


def _windows(w: Column, size: int) -> Column:
    """Array of hashes: of the window that starts at each word (at the end, of what is left: these match none)."""
    return F.transform(w, lambda _, i: F.xxhash64(F.slice(w, i + 1, size)))


def benchmark_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """(item_id, item_hash, size, ipos, wh, slots, need): usable windows; slots: (offset, value) of the placeholders."""
    b = table_rows(benchmark, item_id="item_id", text="text").distinct().withColumn("o", words(F.col("text")))
    b = b.filter(F.size("o") > 0).select("item_id", F.xxhash64("text").alias("item_hash"), "o", F.transform("o", template).alias("c"), F.least(F.lit(size), F.size("o")).alias("size"))
    b = b.select("item_id", "item_hash", "o", "c", "size", F.explode(F.sequence(F.lit(0), F.size("o") - F.col("size"))).alias("ipos"))
    b = b.withColumn("win", F.slice("c", F.col("ipos") + 1, F.col("size"))).withColumn("val", F.slice("o", F.col("ipos") + 1, F.col("size")))
    held = lambda c: c.isin("<number>", "<name>", "<unit>")
    slots = F.filter(F.transform("win", lambda c, i: F.struct(i.alias("at"), held(c).alias("slot"), F.get(F.col("val"), i).alias("value"))), lambda s: s["slot"])
    b = b.select("item_id", "item_hash", "size", "ipos", F.xxhash64("win").alias("wh"), F.transform(slots, lambda s: F.struct(s["at"].alias("at"), s["value"].alias("value"))).alias("slots"))
    b = b.filter(F.col("size") - F.size("slots") >= F.ceil(F.col("size") / 2))
    need = b.groupBy("item_id").agg(F.countDistinct("wh").alias("need"))
    return b.join(need, "item_id")


def hits(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW, min_windows: int = MIN_WINDOWS, broadcast_rows: int = 1_000_000) -> DataFrame:
    """(doc_id, text_hash, item_id, n_windows): the contaminated documents (keyed by id and text) and the items found."""
    bench = written(benchmark_windows(benchmark, size), "benchmark")
    lengths = sorted(r["size"] for r in bench.select("size").distinct().collect())  # at most W values
    if not lengths:
        return documents.sparkSession.createDataFrame([], "doc_id long, text_hash long, item_id long, n_windows long")
    small = bench.count() <= broadcast_rows
    docs = table_rows(documents, doc_id="doc_id", text="text")
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("o"))
    c = docs.select("doc_id", "text_hash", F.transform("o", template).alias("c"))
    found = None
    for n in lengths:
        part = c.select("doc_id", "text_hash", F.posexplode_outer(_windows(F.col("c"), n)).alias("pos", "wh"))  # outer: no second evaluation in an inferred filter
        b = bench.filter(F.col("size") == n).select("item_id", "item_hash", "ipos", "wh", "slots", "need")
        part = part.join(F.broadcast(b) if small else b, "wh").withColumn("shift", F.col("pos") - F.col("ipos")).drop("ipos")
        found = part if found is None else found.unionByName(part)
    found = written(found, "hits")
    key = ["doc_id", "text_hash", "item_id"]
    place = [*key, "item_hash", "shift"]
    check = found.filter(F.size("slots") > 0).select(*place, "pos", "slots").withColumnsRenamed({"doc_id": "k1", "text_hash": "k2"})
    # slots: only the documents with a matched window that has placeholders become words again; they grow
    # with the corpus, so the join is a merge by key at every size
    texts = table_rows(documents, doc_id="doc_id", text="text").withColumn("text_hash", F.xxhash64("text"))
    mine = F.col("doc_id").eqNullSafe(F.col("k1")) & (F.col("text_hash") == F.col("k2"))
    said = texts.join(check.select("k1", "k2").distinct().hint("merge"), mine, "left_semi").select("doc_id", "text_hash", words(F.col("text")).alias("o"))
    said = written(said, "slots").join(check, mine)
    pair = F.transform("slots", lambda s: F.struct(value(s["value"]).alias("b"), value(F.get(F.col("o"), F.col("pos") + s["at"])).alias("d")))
    said = said.select(*place, F.explode(pair).alias("v")).select(*place, "v.b", "v.d").distinct()
    clash = lambda one, other: said.groupBy(*place, one).agg(F.count(other).alias("n")).filter("n > 1").select(*place)
    bad = clash("b", "d").unionByName(clash("d", "b")).distinct()
    bad = bad.toDF("k1", "k2", "k3", "k4", "k5")
    same = F.col("doc_id").eqNullSafe(F.col("k1")) & (F.col("text_hash") == F.col("k2")) & F.col("item_id").eqNullSafe(F.col("k3")) & (F.col("item_hash") == F.col("k4")) & (F.col("shift") == F.col("k5"))
    loose = found.join(bad, same, "left")
    loose = loose.filter(F.col("k2").isNull() | (F.size("slots") == 0))
    n = loose.groupBy(*key, "need").agg(F.countDistinct("wh").alias("n_windows"))
    return n.filter(F.col("n_windows") >= F.least(F.lit(min_windows), F.col("need"))).select(*key, "n_windows")


def contaminated(documents: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, most_windows, item_ids (ascending, comma-joined)."""
    h = written(hits(documents, benchmark, **how), "hits")
    # the items found in one document: at most its words / W of them
    h = h.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"), F.max("n_windows").alias("m"), F.array_join(F.sort_array(F.collect_list("item_id")), ",").alias("ids"))
    h = h.withColumnsRenamed({"doc_id": "k1", "text_hash": "k2"})
    d = table_rows(documents, doc_id="doc_id", text="text").select("doc_id", F.xxhash64("text").alias("text_hash"))
    d = d.join(h, F.col("doc_id").eqNullSafe(F.col("k1")) & (F.col("text_hash") == F.col("k2")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return d.select("doc_id", F.col("k2").isNotNull().alias("contaminated"), zero(F.col("n")).alias("n_items"), zero(F.col("m")).alias("most_windows"), F.coalesce("ids", F.lit("")).alias("item_ids"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents without the contaminated ones, all columns."""
    h = written(hits(documents, benchmark, **how).select(F.col("doc_id").alias("k1"), F.col("text_hash").alias("k2")).distinct(), "hits")
    d = documents.select(F.struct("*").alias("row"))
    d = d.join(h, F.col("row.doc_id").eqNullSafe(F.col("k1")) & (F.xxhash64("row.text") == F.col("k2")), "left_anti")
    return d.select("row.*")


_QUOTED = {k: ", ".join(f"'{w}'" for w in ws) for k, ws in (("units", UNITS), ("numbers", NUMBERS), ("openers", OPENERS))}
_SLOTS = "('<number>', '<name>', '<unit>')"


def _sql_words(text: str) -> str:
    marked = rf"regexp_replace(coalesce({text}, ''), '(^|[^\p{{L}}\p{{N}}])(\p{{Lu}}\p{{Ll}})', '\1' || chr(1) || '\2', 'g')"
    return rf"regexp_extract_all(lower({marked}), '\x01?\p{{L}}+|\p{{N}}+(?:[.,]\p{{N}}+)*')"


def _sql_template(ws: str) -> str:
    bare = "ltrim(w, chr(1))"
    return (
        f"list_transform({ws}, lambda w: CASE WHEN w[1] BETWEEN '0' AND '9' OR {bare} IN ({_QUOTED['numbers']}) THEN '<number>' WHEN w[1] <> chr(1) THEN CASE WHEN w IN ({_QUOTED['units']}) THEN '<unit>' ELSE w END "
        f"WHEN {bare} IN ({_QUOTED['openers']}) THEN {bare} ELSE '<name>' END)"
    )


def _sql_value(w: str) -> str:
    said = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NUMBERS.items())
    return rf"CASE ltrim({w}, chr(1)) {said} ELSE CASE WHEN regexp_matches({w}, '^[0-9]{{1,3}}(,[0-9]{{3}})+(\.[0-9]+)?$') THEN replace({w}, ',', '') ELSE replace({w}, ',', '.') END END"


SQL = rf"""
WITH cb AS (SELECT item_id, item, o, {_sql_template('o')} AS c FROM (SELECT DISTINCT item_id, text AS item, {_sql_words('text')} AS o FROM benchmark) WHERE len(o) > 0),
bi AS (SELECT item_id, item, o, c, least({WINDOW}, len(o)) AS size, unnest(range(0, len(o) - least({WINDOW}, len(o)) + 1)) AS ipos FROM cb),
bw AS (SELECT item_id, item, size, ipos, o[ipos + 1 : ipos + size] AS val, c[ipos + 1 : ipos + size] AS win FROM bi),
bu AS (SELECT *, array_to_string(win, ' ') AS wh FROM bw WHERE size - len(list_filter(win, lambda x: x IN {_SLOTS})) >= ceil(size / 2)),
need AS (SELECT item_id, count(DISTINCT wh) AS need FROM bu GROUP BY item_id),
d AS (SELECT doc_id, o, {_sql_template('o')} AS c FROM (SELECT doc_id, {_sql_words('text')} AS o FROM documents)),
dw AS (SELECT doc_id, size, unnest(range(0, len(c) - size + 1)) AS pos, unnest(list_transform(range(0, len(c) - size + 1), lambda i: array_to_string(c[i + 1 : i + size], ' '))) AS wh
       FROM d, (SELECT DISTINCT size FROM bu)),
f AS (SELECT dw.doc_id, item_id, item, pos - ipos AS shift, bu.wh, win, val, d.o[pos + 1 : pos + bu.size] AS dval FROM dw JOIN bu ON bu.size = dw.size AND bu.wh = dw.wh JOIN d ON d.doc_id = dw.doc_id),
u AS (SELECT doc_id, item_id, item, shift, unnest(win) AS kind, unnest(val) AS b, unnest(dval) AS d FROM f),
v AS (SELECT DISTINCT doc_id, item_id, item, shift, {_sql_value('b')} AS b, {_sql_value('d')} AS d FROM u WHERE kind IN {_SLOTS}),
bad AS (SELECT doc_id, item_id, item, shift FROM v GROUP BY doc_id, item_id, item, shift, b HAVING count(*) > 1
        UNION SELECT doc_id, item_id, item, shift FROM v GROUP BY doc_id, item_id, item, shift, d HAVING count(*) > 1),
n AS (SELECT f.doc_id, f.item_id, count(DISTINCT wh) AS n FROM f LEFT JOIN bad USING (doc_id, item_id, item, shift)
      WHERE bad.item_id IS NULL OR len(list_filter(win, lambda x: x IN {_SLOTS})) = 0 GROUP BY ALL),
h AS (SELECT doc_id, count(*) AS n_items, max(n) AS m, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM n JOIN need USING (item_id) WHERE n >= least({MIN_WINDOWS}, need) GROUP BY doc_id)
SELECT documents.doc_id, h.n_items IS NOT NULL AS contaminated, coalesce(h.n_items, 0) AS n_items, coalesce(m, 0) AS most_windows, coalesce(ids, '') AS item_ids
FROM documents LEFT JOIN h USING (doc_id)
"""
