"""Registered queries over the driver's tables, with the same statements in SQL.

The tables stand in for the citation corpus: orders are papers (venue: priority, year: order date),
line items are edges (order to part number). Whole texts of documents are titles, ids and
duplicates; where titles are compared word by word, whole texts of benchmark items are the papers,
and changed forms of them the references.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions import citations, paths, text
from citeloom.functions.sentences import ABBREVIATIONS, sentences
from citeloom.operators import contexts, corpus, extract, graph, labels, prompts, resolve
from citeloom.schema import CALENDAR, STOP_WORDS
from citeloom.streaming import incremental

CORE = ("1-URGENT", "2-HIGH")
TRAIN, EVAL = (1995, 1999), (2000, 2000)

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def _query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("paper_id"), F.col("o_orderpriority").alias("venue"), F.year("o_orderdate").alias("year"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("paper_id"), F.col("l_partkey").alias("matched_paper_id"))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = (F.lit(2000) + F.pmod("doc_id", F.lit(20))).cast("int")
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), F.col("doc_id").cast("string").alias("paper_id"), F.col("text").alias("title"), F.col("source").alias("venue"), year.alias("year"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as papers."""
    year = (F.lit(2000) + F.pmod("item_id", F.lit(20))).cast("int")
    return _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("pos"), F.col("item_id").cast("string").alias("paper_id"), F.col("text").alias("title"), F.concat(F.lit("src"), (F.col("item_id") % 5).cast("string")).alias("venue"), year.alias("year"))


#: What is done to an item's title for its references, in Spark's SQL and DuckDB's alike.
_FORMS = ("title || '!'", "title || ' zzzq'", "reverse(title)")


def refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three references to each item: its title with a mark, with a word more, and backwards."""
    year = F.when(F.pmod("pos", F.lit(3)) == 0, F.lit(None)).otherwise(F.col("year")).cast("int")
    forms = F.array(*[F.struct(F.lit(k).alias("form"), F.expr(said).alias("title")) for k, said in enumerate(_FORMS)])
    made = items(spark, sf_dir).select("pos", year.alias("year"), F.inline(forms))
    return made.select((3 * F.col("pos") + F.col("form")).alias("ref_id"), "title", "year")


_PAPERS = "SELECT o_orderkey AS paper_id, o_orderpriority AS venue, year(o_orderdate)::INTEGER AS year FROM orders"
_GRAPH = f"""
WITH p AS ({_PAPERS}),
core AS (SELECT * FROM p WHERE venue IN ('1-URGENT', '2-HIGH')),
cited AS (
    SELECT DISTINCT l_partkey AS paper_id FROM lineitem
    WHERE l_orderkey IN (SELECT paper_id FROM core) AND l_partkey IN (SELECT paper_id FROM p WHERE venue NOT IN ('1-URGENT', '2-HIGH'))),
reduced AS (SELECT * FROM p WHERE paper_id IN (SELECT paper_id FROM core UNION SELECT paper_id FROM cited)),
train AS (SELECT * FROM reduced WHERE year BETWEEN 1995 AND 1999),
eval AS (SELECT * FROM reduced WHERE year = 2000 AND venue IN ('1-URGENT', '2-HIGH'))
"""
_NORM = r"trim(regexp_replace(regexp_replace(lower(coalesce({0}, '')), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+', ' ', 'g'))"
_TITLES = "SELECT doc_id AS pos, doc_id::VARCHAR AS paper_id, text AS title, source AS venue, (2000 + doc_id % 20)::INTEGER AS year FROM documents"
_ITEMS = "SELECT item_id AS pos, item_id::VARCHAR AS paper_id, text AS title, 'src' || (item_id % 5) AS venue, (2000 + item_id % 20)::INTEGER AS year FROM benchmark"
_REFS = " UNION ALL ".join(f"SELECT 3 * pos + {k} AS ref_id, pos AS item, {k} AS form, {said} AS title, CASE WHEN pos % 3 <> 0 THEN year END AS year FROM ({_ITEMS})" for k, said in enumerate(_FORMS))


# --- graph and splits ----------------------------------------------------------------------------


@_query(_GRAPH + "SELECT * FROM core")
def q_core_set(spark, sf_dir):
    return graph.core_papers(papers(spark, sf_dir), CORE)


@_query(_GRAPH + "SELECT * FROM cited")
def q_cited_set(spark, sf_dir):
    return graph.cited_ids(papers(spark, sf_dir), edges(spark, sf_dir), CORE)


@_query(_GRAPH + "SELECT * FROM reduced")
def q_reduced_graph(spark, sf_dir):
    return graph.reduce_graph(papers(spark, sf_dir), edges(spark, sf_dir), CORE)


def _split(spark, sf_dir):
    return graph.split_papers(q_reduced_graph(spark, sf_dir), CORE, TRAIN, EVAL)


@_query(_GRAPH + "SELECT * FROM train")
def q_train(spark, sf_dir):
    return _split(spark, sf_dir)[0]


@_query(_GRAPH + "SELECT * FROM eval")
def q_eval(spark, sf_dir):
    return _split(spark, sf_dir)[1]


@_query(_GRAPH + "SELECT part, venue, count(*) AS n FROM (SELECT 'train' AS part, venue FROM train UNION ALL SELECT 'eval', venue FROM eval) GROUP BY part, venue")
def q_split_counts(spark, sf_dir):
    train, evaluation = _split(spark, sf_dir)
    both = train.select(F.lit("train").alias("part"), "venue").unionByName(evaluation.select(F.lit("eval").alias("part"), "venue"))
    return both.groupBy("part", "venue").agg(F.count("*").alias("n"))


_CALENDAR_SQL = ", ".join(f"('{v}', {a}, {b}, '{p}')" for v, (a, b, p) in CALENDAR.items())


@_query(f"""
WITH c(venue, a, b, parity) AS (VALUES {_CALENDAR_SQL}),
cells AS (SELECT venue, unnest(range(a, b + 1))::INTEGER AS year, parity FROM c),
n AS (SELECT year, count(*) AS papers FROM ({_PAPERS}) GROUP BY year)
SELECT venue, cells.year, coalesce(papers, 0) AS papers FROM cells LEFT JOIN n ON n.year = cells.year
WHERE parity = '' OR (cells.year % 2 = 0) = (parity = 'even')""")
def q_calendar(spark, sf_dir):
    counts = papers(spark, sf_dir).groupBy("year").agg(F.count("*").alias("papers"))
    return graph.calendar(spark).join(counts, "year", "left").select("venue", "year", F.coalesce("papers", F.lit(0)).alias("papers"))


# --- ids, titles, years, paths -------------------------------------------------------------------

_DIGEST = "sha1(unhex('f47ac10b58cc4372a5670d02b2c3d479') || encode(key))"


@_query(rf"""
WITH k AS (
    SELECT pos, concat_ws('|', regexp_replace(lower(title), '^\s+|\s+$', '', 'g'), venue, year::VARCHAR, paper_id) AS key FROM ({_TITLES})),
d AS (SELECT pos, {_DIGEST} AS h FROM k)
SELECT pos, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
    || substr('89ab', (instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS paper_id FROM d""")
def q_paper_id(spark, sf_dir):
    rows = titles(spark, sf_dir)
    return rows.select("pos", text.paper_id(F.col("title"), F.col("venue"), F.col("year"), F.col("paper_id")).alias("paper_id"))


@_query(f"WITH t AS ({_TITLES}) SELECT pos, title FROM t WHERE title IN (SELECT title FROM t GROUP BY title HAVING count(*) > 1)")
def q_dup_ids(spark, sf_dir):
    return corpus.duplicates(titles(spark, sf_dir).select("pos", "title"), "title").select("pos", "title")


@_query(f"SELECT paper_id, venue, year, row_number() OVER (ORDER BY year, venue, paper_id) - 1 AS pos FROM ({_PAPERS})")
def q_corpus_sorted_pos(spark, sf_dir):
    return corpus.in_order(papers(spark, sf_dir), "year", "venue", "paper_id")


@_query(f"SELECT pos, {_NORM.format('title')} AS norm FROM ({_TITLES})")
def q_title_norm(spark, sf_dir):
    return titles(spark, sf_dir).select("pos", text.normalize_title(F.col("title")).alias("norm"))


_YEAR_CASES = """CASE o_orderkey % 6
    WHEN 0 THEN '[12] A. Lee. Deep nets. ' || y || '. Some venue' WHEN 1 THEN 'Lee et al. (' || y || 'a) Ann Lee. Title.'
    WHEN 2 THEN 'A. Lee, Title, pp. 1998-2005, ' || y WHEN 3 THEN 'Lee [' || y || 'b] Title' WHEN 4 THEN 'arXiv 1905.12345 in ' || y || ' preprint' ELSE 'Caption without date' END"""


@_query(rf"""
WITH r AS (SELECT o_orderkey AS id, {_YEAR_CASES} AS ref FROM (SELECT o_orderkey, year(o_orderdate)::VARCHAR AS y FROM orders)),
m AS (SELECT id, regexp_extract(ref, '\[(\d{{4}})[a-z]?\]', 1) AS a, regexp_extract(ref, '\((\d{{4}})[a-z]?\)', 1) AS b,
    regexp_extract(ref, '(?:^|\s)(\d{{4}})[a-z]?\.', 1) AS c, regexp_extract(ref, ',\s*(\d{{4}})[a-z]?\s*\.?\s*$', 1) AS d,
    regexp_extract_all(ref, '\b((?:19|20)\d{{2}})\b', 1) AS e FROM r)
SELECT id, coalesce(nullif(a, ''), nullif(b, ''), nullif(c, ''), nullif(d, ''), e[-1])::INTEGER AS year FROM m""")
def q_year_extract(spark, sf_dir):
    years = _table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("y"))
    return years.select(F.col("o_orderkey").alias("id"), text.extract_year(F.expr(_YEAR_CASES)).alias("year"))


@_query(r"""
WITH p AS (SELECT page_id, 'x/grobid_output/' || page_id || '/2020/p' || page_id || '_Deep_Nets.grobid.tei.xml' AS path FROM pages)
SELECT page_id, '/root/citation_contexts/' || page_id || '/2020/p' || page_id || '_Deep_Nets.json' AS context_path, 'Deep Nets.grobid.tei' AS title FROM p""")
def q_path_map(spark, sf_dir):
    made = _table(spark, sf_dir, "pages").select("page_id", F.format_string("x/grobid_output/%1$d/2020/p%1$d_Deep_Nets.grobid.tei.xml", "page_id").alias("path"))
    return made.select("page_id", paths.corpus_to_contexts(F.col("path"), "/root/citation_contexts").alias("context_path"), paths.title_of_file(F.col("path")).alias("title"))


@_query("""
SELECT d.doc_id, coalesce('tei/' || l.doc_id, 'ocr/' || c.conv_id, '') AS source_path FROM documents d
LEFT JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN (SELECT DISTINCT conv_id FROM conversations) c ON c.conv_id = d.doc_id""")
def q_source_priority(spark, sf_dir):
    tei = _table(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("tei/"), F.col("doc_id").cast("string")).alias("path"))
    ocr = _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id")).distinct().withColumn("path", F.concat(F.lit("ocr/"), F.col("doc_id").cast("string")))
    return corpus.pick_sources(_table(spark, sf_dir, "documents").select("doc_id"), {"tei": tei, "ocr": ocr}, "doc_id")


# --- resolution ----------------------------------------------------------------------------------

_DICT = f"SELECT norm, arg_min(paper_id, pos) AS matched_paper_id, arg_min(title, pos) AS matched_title, arg_min(venue, pos) AS venue FROM (SELECT *, {_NORM.format('title')} AS norm FROM ({_TITLES})) GROUP BY norm"


@_query(f"SELECT r.ref_id, d.matched_paper_id, d.venue FROM (SELECT *, {_NORM.format('title')} AS norm FROM (SELECT pos AS ref_id, title FROM ({_TITLES}))) r LEFT JOIN ({_DICT}) d ON d.norm = r.norm")
def q_exact_resolve(spark, sf_dir):
    every = titles(spark, sf_dir)
    asked = every.select(F.col("pos").alias("ref_id"), "title")
    return resolve.exact_matches(asked, every).select("ref_id", "matched_paper_id", "venue")


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)


@_query(f"""
WITH t AS (SELECT pos, year AS paper_year, {_NORM.format('title')} AS norm FROM ({_ITEMS})),
r AS (SELECT ref_id, year AS ref_year, {_NORM.format('title')} AS norm FROM ({_REFS})),
tw AS (SELECT DISTINCT pos, paper_year, w FROM (SELECT pos, paper_year, unnest(string_split(norm, ' ')) AS w FROM t) WHERE w NOT IN ('', {_STOP})),
rw AS (SELECT DISTINCT ref_id, ref_year, w FROM (SELECT ref_id, ref_year, unnest(string_split(norm, ' ')) AS w FROM r) WHERE w NOT IN ('', {_STOP})),
c AS (SELECT ref_id, pos, count(*) AS overlap FROM rw JOIN tw ON rw.w = tw.w AND (ref_year IS NULL OR abs(paper_year - ref_year) <= 1) GROUP BY ref_id, pos),
k AS (SELECT *, row_number() OVER (PARTITION BY ref_id ORDER BY overlap DESC, pos)::INTEGER AS rank FROM c)
SELECT ref_id, pos, overlap, rank FROM k WHERE rank <= 25""")
def q_fuzzy_candidates_top25(spark, sf_dir):
    return resolve.candidates(refs(spark, sf_dir), items(spark, sf_dir)).select("ref_id", "pos", "overlap", "rank")


# A title's own item is the only similar one, so scores have a closed form: 100 for an equal title; with
# a word of four letters more the ratio of the common part, or the weighted 95 of an equal set of words.
_FUZZY = f"""
WITH t AS (SELECT *, {_NORM.format('title')} AS norm FROM ({_ITEMS})),
r AS (SELECT *, {_NORM.format('title')} AS norm FROM ({_REFS})),
e AS (SELECT r.ref_id, arg_min(t.paper_id, t.pos) AS paper_id, arg_min(t.title, t.pos) AS title, arg_min(t.venue, t.pos) AS venue FROM r JOIN t ON t.norm = r.norm GROUP BY r.ref_id),
f AS (SELECT r.ref_id, min(t.pos) AS pos, CASE r.form WHEN 0 THEN 100.0::DOUBLE ELSE greatest(95.0::DOUBLE, 200.0::DOUBLE * any_value(length(t.norm)) / any_value(2 * length(t.norm) + 5)) END AS score
    FROM r JOIN t ON r.norm = t.norm || CASE r.form WHEN 0 THEN '' ELSE ' zzzq' END AND (r.year IS NULL OR abs(t.year - r.year) <= 1) WHERE r.form < 2 GROUP BY r.ref_id, r.form),
m AS (SELECT r.ref_id, r.title, r.year, CASE WHEN e.ref_id IS NOT NULL THEN 'exact' WHEN f.ref_id IS NOT NULL THEN 'fuzzy' ELSE 'no_match' END AS match_type,
    coalesce(e.paper_id, t.paper_id, '') AS matched_paper_id, coalesce(e.title, t.title, '') AS matched_title, coalesce(e.venue, t.venue, '') AS matched_venue
    FROM r LEFT JOIN e ON e.ref_id = r.ref_id LEFT JOIN f ON f.ref_id = r.ref_id LEFT JOIN t ON t.pos = f.pos)
"""


@_query(_FUZZY + "SELECT ref_id, pos, score FROM f")
def q_fuzzy_best(spark, sf_dir):
    return resolve.fuzzy_matches(refs(spark, sf_dir), items(spark, sf_dir))


_SHORT_LIST = ("src0", "src1", "src2")


@_query(_FUZZY + "SELECT *, match_type <> 'no_match' AS in_dataset, lower(matched_venue) IN ('src0', 'src1', 'src2') AS in_conference_list FROM m")
def q_resolve(spark, sf_dir):
    return resolve.with_flags(resolve.resolve(refs(spark, sf_dir), items(spark, sf_dir)), _SHORT_LIST)


@_query(_FUZZY + "SELECT coalesce(match_type, 'total') AS match_type, count(*) AS n FROM m GROUP BY ROLLUP (match_type)")
def q_match_stats(spark, sf_dir):
    return resolve.match_stats(resolve.resolve(refs(spark, sf_dir), items(spark, sf_dir)))


@_query(_FUZZY + "SELECT ref_id, match_type <> 'no_match' AS in_dataset, lower(matched_venue) IN ('src0', 'src1', 'src2') AS in_conference_list FROM m")
def q_flags(spark, sf_dir):
    found = resolve.resolve(refs(spark, sf_dir), items(spark, sf_dir))
    return resolve.with_flags(found, _SHORT_LIST).select("ref_id", "in_dataset", "in_conference_list")


# --- labels --------------------------------------------------------------------------------------


def _label_edges(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select(F.col("source").alias("paper_id"), F.col("doc_id").cast("string").alias("target"))


def _scores(spark, sf_dir):
    both = _table(spark, sf_dir, "labels").join(_table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return both.select(F.col("source").alias("paper_id"), F.col("doc_id").cast("string").alias("target"), F.col("doc_id").alias("row_pos"), F.col("quality").cast("string").alias("type_1_output"), F.lit("x").alias("type_2_output"), F.col("toxic").cast("string").alias("type_3_output"))


@_query("""
SELECT d.source AS paper_id, d.doc_id::VARCHAR AS target, coalesce(quality::VARCHAR, '') AS type_1_output, '' AS type_2_output, coalesce(toxic::VARCHAR, '') AS type_3_output
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def q_labels_left(spark, sf_dir):
    return labels.attach_labels(_label_edges(spark, sf_dir), _scores(spark, sf_dir))


@_query("""
SELECT d.source AS paper_id, d.doc_id::VARCHAR AS target FROM documents d
WHERE d.source IN (SELECT source FROM documents JOIN labels USING (doc_id)) AND d.doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_labels_missing(spark, sf_dir):
    return labels.missing_labels(_label_edges(spark, sf_dir), _scores(spark, sf_dir))


@_query("SELECT l_orderkey AS paper_id, l_partkey AS matched_paper_id, count(*) AS n FROM lineitem GROUP BY ALL")
def q_nested_roundtrip(spark, sf_dir):
    """Edges nested by paper, encoded as JSON, decoded and exploded again."""
    listed = edges(spark, sf_dir).groupBy("paper_id").agg(F.sort_array(F.collect_list(F.struct("matched_paper_id"))).alias("refs"))
    back = listed.withColumn("refs", F.from_json(F.to_json("refs"), "array<struct<matched_paper_id:bigint>>")).select("paper_id", F.inline("refs"))
    return back.groupBy("paper_id", "matched_paper_id").agg(F.count("*").alias("n"))


# --- contexts ------------------------------------------------------------------------------------

_SENTENCES_SQL = "['Intro of ' || o_orderkey || '.', 'Work (citation #b' || (o_orderkey % 3) || ') and (citation #b' || (o_orderkey % 5) || ').', 'Middle part.', 'Again (citation #b' || (o_orderkey % 3) || ').', 'End.']"


def _sentences(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    mod = lambda n: (F.col("o_orderkey") % n).cast("string")
    made = F.array(F.concat(F.lit("Intro of "), key, F.lit(".")), F.concat(F.lit("Work (citation #b"), mod(3), F.lit(") and (citation #b"), mod(5), F.lit(").")), F.lit("Middle part."), F.concat(F.lit("Again (citation #b"), mod(3), F.lit(").")), F.lit("End."))
    return _table(spark, sf_dir, "orders").select("o_orderkey", made.alias("sentences"))


_WINDOWS = rf"""
WITH s AS (SELECT o_orderkey, {_SENTENCES_SQL} AS sentences FROM orders),
p AS (SELECT o_orderkey, sentences, unnest(range(0, len(sentences))) AS sentence_pos FROM s),
m AS (SELECT o_orderkey, sentences, sentence_pos, unnest(list_distinct(regexp_extract_all(sentences[sentence_pos + 1], '\(citation #([^)]+)\)', 1))) AS target FROM p),
w AS (SELECT o_orderkey, sentence_pos::INTEGER AS sentence_pos, target, array_to_string(sentences[greatest(0, least(sentence_pos - 1, len(sentences) - 3)) + 1:greatest(0, least(sentence_pos - 1, len(sentences) - 3)) + 3], ' ') AS context FROM m)
"""


@_query(_WINDOWS + "SELECT o_orderkey, target, count(*) AS n FROM m GROUP BY ALL")
def q_markers(spark, sf_dir):
    rows = contexts.windows_of_sentences(_sentences(spark, sf_dir), "sentences")
    return rows.groupBy("o_orderkey", "target").agg(F.count("*").alias("n"))


@_query(_WINDOWS + "SELECT * FROM w")
def q_window3(spark, sf_dir):
    return contexts.windows_of_sentences(_sentences(spark, sf_dir), "sentences").select("o_orderkey", "sentence_pos", "target", "context")


@_query(_WINDOWS + "SELECT o_orderkey, target, context, min(sentence_pos) AS sentence_pos FROM w GROUP BY ALL")
def q_ctx_dedupe(spark, sf_dir):
    rows = contexts.windows_of_sentences(_sentences(spark, sf_dir), "sentences")
    return contexts.first_occurrences(rows, ["o_orderkey", "target", "context"], ["sentence_pos"]).select("o_orderkey", "target", "context", "sentence_pos")


@_query("""
SELECT conv_id, turn, coalesce(last_value(CASE WHEN role = 'user' THEN 'u' || turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS section
FROM conversations""")
def q_section_ffill(spark, sf_dir):
    heads = _table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.concat(F.lit("u"), F.col("turn").cast("string"))).alias("head"))
    return contexts.forward_fill(heads, ["conv_id"], ["turn"], "head", "section").select("conv_id", "turn", F.coalesce("section", F.lit("")).alias("section"))


@_query("""
WITH f AS (SELECT *, CASE WHEN event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM f)
SELECT user_id, run::BIGINT AS run, event_type, count(*) AS n FROM r GROUP BY ALL""")
def q_run_merge(spark, sf_dir):
    runs = contexts.run_ids(_table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "event_type")
    return runs.groupBy("user_id", "run", "event_type").agg(F.count("*").alias("n"))


@_query("""
WITH o AS (SELECT conv_id, turn * 10 AS pos FROM conversations),
s AS (SELECT conv_id, min(turn) * 10 AS start, max(turn) * 10 AS "end", 'part' || conv_id AS label FROM conversations GROUP BY conv_id)
SELECT o.conv_id, o.pos, coalesce(s.label, '') AS section FROM o LEFT JOIN s ON s.conv_id = o.conv_id AND s.start <= o.pos AND o.pos < s."end" """)
def q_section_of_occurrence(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations")
    found = turns.select("conv_id", (F.col("turn") * 10).alias("pos"))
    spans = turns.groupBy("conv_id").agg((F.min("turn") * 10).alias("start"), (F.max("turn") * 10).alias("end")).withColumn("label", F.concat(F.lit("part"), F.col("conv_id").cast("string")))
    return contexts.section_of(found, spans, ["conv_id"])


# --- prompts and resume --------------------------------------------------------------------------


def _prompt_refs(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations")
    listed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    made = F.when(F.col("conv_id") % 4 == 0, F.array().cast("array<struct<section:string,context:string>>")).otherwise(F.transform("t", lambda x: F.struct(x["role"].alias("section"), x["text"].alias("context"))))
    return listed.select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("paper_file"), F.lit("Paper").alias("paper_title"), F.concat(F.lit("b"), (F.col("conv_id") % 7).cast("string")).alias("target"), F.lit("T").alias("title"),
        F.lit("[1]").alias("cite"), made.alias("contexts"), (F.col("conv_id") % 2 == 0).alias("in_dataset"), (F.col("conv_id") % 3 == 0).alias("in_conference_list"),
    )


_PROMPT_REFS = """
WITH c AS (SELECT conv_id, CASE WHEN conv_id % 4 = 0 THEN '' ELSE string_agg(i || '. Section: "' || role || '"' || chr(10) || '   Context: "' || text || '"', chr(10) ORDER BY turn) END AS said
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations) GROUP BY conv_id),
k AS (SELECT * FROM c WHERE conv_id % 2 = 0 OR conv_id % 3 = 0)
"""


def _prompt_sql(kind: int) -> str:
    return f"""SELECT 'c' || conv_id AS paper_file, 'b' || (conv_id % 7) AS target, {kind} AS prompt_type, conv_id % 4 = 0 AS is_empty,
        'ref_b' || (conv_id % 7) || '_type_{kind}' || CASE WHEN conv_id % 4 = 0 THEN '_empty' ELSE '' END || '.txt' AS file_name,
        '[SYSTEM]' || chr(10) || '{prompts.SYSTEM[kind]}' || chr(10) || chr(10) || '[USER]' || chr(10) || 'Paper Title: Paper' || chr(10) || chr(10) || 'Citation: "cited_as": "[1]", "title": "T"' || chr(10) || chr(10)
        || 'Citation Contexts:' || chr(10) || said || chr(10) || chr(10) || '{prompts.QUESTION[kind].replace(chr(39), chr(39) * 2).replace(chr(10), "' || chr(10) || '")}' AS text FROM k""".replace("paper's", "paper''s")


@_query(_PROMPT_REFS + _prompt_sql(1) + " UNION ALL " + _prompt_sql(2))
def q_prompt_build(spark, sf_dir):
    return prompts.build_prompts(_prompt_refs(spark, sf_dir))


@_query("""
SELECT 'c' || conv_id AS paper_file, 1::BIGINT AS total, CASE WHEN conv_id % 2 = 0 OR conv_id % 3 = 0 THEN 2 ELSE 0 END::BIGINT AS generated, CASE WHEN conv_id % 4 = 0 THEN 2 ELSE 0 END::BIGINT AS empty
FROM (SELECT DISTINCT conv_id FROM conversations)""")
def q_prompt_stats(spark, sf_dir):
    return prompts.prompt_stats(_prompt_refs(spark, sf_dir))


def _status(spark, sf_dir):
    state = F.when(F.col("toxic") == 1, "error").when(F.col("quality") == 0, "skipped").otherwise("processed")
    return _table(spark, sf_dir, "labels").select(F.lit("contexts").alias("stage"), F.col("doc_id").alias("output_path"), state.alias("status"))


@_query("SELECT doc_id AS output_path FROM documents WHERE doc_id NOT IN (SELECT conv_id FROM conversations) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic IS DISTINCT FROM 1)")
def q_resume_todo(spark, sf_dir):
    inputs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("output_path"))
    outputs = _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("output_path"))
    return incremental.to_do(inputs, outputs, _status(spark, sf_dir), retry_errors=True)


@_query("SELECT 'contexts' AS stage, CASE WHEN toxic = 1 THEN 'error' WHEN quality = 0 THEN 'skipped' ELSE 'processed' END AS status, count(*) AS n FROM labels GROUP BY ALL")
def q_status_counts(spark, sf_dir):
    return incremental.status_counts(_status(spark, sf_dir))


@_query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def q_event_counts(spark, sf_dir):
    return incremental.running_counts(_table(spark, sf_dir, "events"))


# --- parsers -------------------------------------------------------------------------------------


_ABBREVIATIONS = ", ".join(f"'{w}'" for w in sorted(ABBREVIATIONS))


@_query(rf"""
WITH x AS (SELECT doc_id, text, regexp_extract_all(text, '(?s)[^.!?]*[.!?]') AS parts FROM documents WHERE text IS NOT NULL),
nr AS (SELECT doc_id, text, unnest(parts) AS part, unnest(range(len(parts))) AS nr FROM x),
m AS (SELECT doc_id, text, sum(length(part)) OVER (PARTITION BY doc_id ORDER BY nr)::BIGINT AS place FROM nr),
c AS (
    SELECT *, substr(text, place, 1) AS mark, substr(text, greatest(1, place - 200), place - greatest(1, place - 200)) AS ahead, substr(text, place + 1, 1) AS behind,
        regexp_extract(substr(text, place + 1, 9), '(?s)^\s*(.)', 1) AS nxt FROM m),
d AS (
    SELECT *, regexp_extract(ahead, '\p{{L}}*$') AS word, regexp_matches(right(ahead, 15) || '.', '(?:[A-Za-z]{{1,4}}\.){{2,}}$') AS dotted FROM c),
e AS (
    SELECT doc_id, text, place FROM d
    WHERE NOT regexp_matches(ahead, '\([^()]{{0,198}}$') AND (nxt = '' OR regexp_matches(nxt, '\p{{Lu}}') OR nxt IN ('(', '"', '''', '['))
        AND NOT (mark = '.' AND (behind IN ('/', '.') OR regexp_matches(right(ahead, 1) || behind, '^[\p{{L}}\p{{N}}]{{2}}$') OR dotted AND regexp_matches(behind, '\p{{L}}')
            OR word IN ({_ABBREVIATIONS}) OR regexp_matches(word, '^\p{{Lu}}$') AND NOT dotted OR regexp_matches(ahead, '[vV][\d.]*\d$')))
    UNION ALL SELECT doc_id, text, length(text) + 1 FROM x),
s AS (
    SELECT doc_id, place, regexp_replace(substr(text, prior + 1, place - prior), '^\s+|\s+$', '', 'g') AS sentence
    FROM (SELECT *, coalesce(lag(place) OVER (PARTITION BY doc_id ORDER BY place), 0) AS prior FROM e))
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1)::INTEGER AS sentence_pos, sentence FROM s WHERE sentence <> ''""")
def q_sentences(spark, sf_dir):
    """The SQL takes parentheses as not nested, which holds for the documents."""
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(sentences("text")).alias("sentence_pos", "sentence"))


_BODY = """CASE o_orderkey % 4 WHEN 0 THEN 'Lee et al. (2019) and Kim (2020) but [1].' WHEN 1 THEN 'as in [1, 2] and [3] or [ABC17]' WHEN 2 THEN 'tags [DKS19] and [GDDM14] here' ELSE 'nothing' END || ' No ' || o_orderkey"""


@_query(r"""
WITH b AS (SELECT o_orderkey, BODY AS body FROM orders),
v AS (SELECT o_orderkey, len(regexp_extract_all(body, '[A-Z][a-z]+(?:\s+(?:and|et)\s+[A-Za-z. ]+?)?\s*[\(\[]\d{4}[a-z]?[\)\]]')) AS author_year,
    len(regexp_extract_all(body, '\[\d+(?:,\s*\d+)*\]')) AS numeric, len(regexp_extract_all(body, '\[[A-Z][A-Za-z+\\(){}^]+\d{2,4}[a-z]?\]')) AS alpha_tag FROM b)
SELECT *, CASE WHEN author_year > greatest(numeric, alpha_tag) THEN 'author_year' WHEN numeric >= alpha_tag THEN 'numeric' ELSE 'alpha_tag' END AS style FROM v""".replace("BODY", _BODY))
def q_style_vote(spark, sf_dir):
    body = _table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_BODY).alias("body"))
    count = lambda p: F.regexp_count("body", F.lit(p.pattern)).cast("long")
    votes = body.select("o_orderkey", count(citations.AUTHOR_YEAR).alias("author_year"), count(citations.NUMERIC).alias("numeric"), count(citations.ALPHA_TAG).alias("alpha_tag"))
    style = F.when(F.col("author_year") > F.greatest("numeric", "alpha_tag"), "author_year").when(F.col("numeric") >= F.col("alpha_tag"), "numeric").otherwise("alpha_tag")
    return votes.withColumn("style", style)


def _parsed(spark, sf_dir, source: str, document: str):
    docs = _table(spark, sf_dir, "orders").select("o_orderkey", F.expr(document).alias("content"))
    rows = extract.references_of(extract.extract_contexts(docs, source), ["o_orderkey"])
    return rows.select("o_orderkey", "target", "source_id", "title", F.col("year").cast("long").alias("year"), F.inline("contexts")).select("o_orderkey", "target", "source_id", "title", "year", "section", "context")


def _case(shapes, said, spark_sql: bool = False) -> str:
    """A CASE over the shapes, of which an order's number chooses one; "~" stands for the number."""

    def text(x) -> str:
        x = str(x).replace("'", "''")
        return "'" + (x.replace("\\", "\\\\").replace("''", "\\'") if spark_sql else x).replace("\n", "\\n" if spark_sql else "' || chr(10) || '") + "'"

    cases = " ".join(f"WHEN {k} THEN replace({text(said(x))}, '~', o_orderkey::VARCHAR)" for k, x in enumerate(shapes))
    return f"CASE o_orderkey % {len(shapes)} {cases} END".replace("o_orderkey::VARCHAR", "CAST(o_orderkey AS STRING)" if spark_sql else "o_orderkey::VARCHAR")


def _expected(shapes, target: str, source_id, context, year: str = "{0}") -> str:
    return f"""SELECT o_orderkey, '{target}' AS target, {_case(shapes, source_id)} AS source_id, {_case(shapes, lambda x: x[-2])} AS title,
        {year.format(_case(shapes, lambda x: x[-1]))}::BIGINT AS year, '1 Intro' AS section, {_case(shapes, context)} AS context FROM orders"""


#: TEI shapes: title and date of the entry, with title and year.
_TEI_SHAPES = (
    ('<analytic><title type="main">Paper ~ of it</title></analytic><monogr><title>Some venue</title><imprint><date when="2004-05"/></imprint></monogr>', "Paper ~ of it", 2004),
    ('<analytic><title level="a" type="main">Study ~ of it</title></analytic><monogr><imprint><date type="published" when="1998"/></imprint></monogr>', "Study ~ of it", 1998),
    ('<monogr><title level="m">Book ~ of it</title><imprint><date when="2011-12-01"/></imprint></monogr>', "Book ~ of it", 2011),
)


def _tei(shape) -> str:
    return (
        '<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body><div><head n="1">Intro</head><p>First of ~. We use <ref type="bibr" target="#b1">[1]</ref> here</p><formula>x = ~</formula><p>and go on. Last one.</p></div></body>'
        + '<back><div><listBibl><biblStruct xml:id="b0"><analytic><title>No year here</title></analytic></biblStruct><biblStruct xml:id="b1">' + shape[0] + "</biblStruct></listBibl></div></back></text></TEI>"
    )


@_query(_expected(_TEI_SHAPES, "b0", lambda x: "b1", lambda x: "First of ~. We use (citation #b1) here x = ~ and go on. Last one."))
def q_tei_contexts(spark, sf_dir):
    return _parsed(spark, sf_dir, "tei", _case(_TEI_SHAPES, _tei, True))


#: OCR shapes: an entry and what cites it, with its title and year.
_OCR_ENTRIES = (
    ("[2] B. Kim. Forests of ~ and more trees. In Proc., 2020.", "[2]", "Forests of ~ and more trees", 2020),
    ("Lee, A.; and Kim, B. 2018. Small ~ trees of the north. In X.", "Lee and Kim (2018)", "Small ~ trees of the north", 2018),
    ("A. Lee, B. Kim (2017)Wide ~ rivers: a study. In Y.", "Lee et al. (2017)", "Wide ~ rivers: a study", 2017),
    ("Lee and Kim and Park (2016) Ann Lee. Deep ~ lakes of old. _Venue_.", "Lee et al. (2016)", "Deep ~ lakes of old", 2016),
    ("[DKS19] Rowan Birch, U. Cedar, _Fast ~ growth and slow decay_, 2019.", "[DKS19]", "Fast ~ growth and slow decay", 2019),
    ("Birch, R. 2001. Mixed ~ forests of it. _Journal of Woods_ 45.", "Birch (2001)", "Mixed ~ forests of it", 2001),
    ("Lee et al. [2015] Ann Lee. High ~ hills of old. In Z.", "Lee et al. [2015]", "High ~ hills of old", 2015),
    ("(7) R. Birch and U. Cedar. Low ~ plains of old. In W, 2014.", "(7)", "Low ~ plains of old", 2014),
    ("R. Birch and U. Cedar (2013)Dry ~ sands of old. In V.", "Birch and Cedar (2013)", "Dry ~ sands of old", 2013),
    ("A Lee, B Kim, 2012. Cold ~ winds of old. In U.", "Lee et al. (2012)", "Cold ~ winds of old", 2012),
    ("Ann Lee, Bob Kim, Cy Elm. 2011. Warm ~ rains of old. In T.", "Lee et al. (2011)", "Warm ~ rains of old", 2011),
)
#: Ways to part the entries of a section: bullets, blank lines, lines.
_OCR_SHAPES = tuple((cut, *entry) for entry in _OCR_ENTRIES for cut in ("\n* ", "\n\n", "\n"))


def _ocr(shape) -> str:
    entries = ["A. Elm. Old things of no known date at all. Some place.", shape[1], "C. Elm. Small trees of the south. 2010.", "D. Elm. Big trees of the east. 2009."]
    return f"# Paper\n\n## 1 Intro\n\nFirst of ~. We follow {shape[2]} here. Last one.\n\n## References\n" + "".join(shape[0] + e for e in entries) + "\n"


@_query(_expected(_OCR_SHAPES, "b0", lambda x: "b1", lambda x: f"First of ~. We follow {x[2]} here. Last one."))
def q_ocr_contexts(spark, sf_dir):
    return _parsed(spark, sf_dir, "ocr", _case(_OCR_SHAPES, _ocr, True))


#: Alternative shapes: entry, its id, what cites it and what becomes of that, with title and year.
_ALT_SHAPES = (
    ("- [1] Oak. Growing x~ forests. In *Venue*, 2001.", "1", "[1, 9]", "(citation #1)[9]", "Growing x~ forests", 2001),
    ("- [1] Oak. Felling x~ forests. 2003.", "1", "[9, 1]", "[9](citation #1)", "Felling x~ forests", 2003),
    ('<span id="page-3-1"></span>A. Lee, B. Kim. 2019. [Linked x~ title](http://x) of it.', "page-3-1", "[Lee 2019](#page-3-1) and [Elm \\(2001\\)](#page-9-9)", "(citation #page-3-1) and Elm (2001)", "Linked x~ title", 2019),
    ('<span id="page-3-1"></span>Lee et al. Wide x~ rivers. In *Venue*, 2018.', "page-3-1", "[Lee](#page-3-1)", "(citation #page-3-1)", "Wide x~ rivers", 2018),
    ('<span id="page-3-1"></span>Lee, Ann. 2017. Deep x~ lakes of old. In Proceedings.', "page-3-1", "[Lee](#page-3-1)", "(citation #page-3-1)", "Deep x~ lakes of old", 2017),
)


def _alt(shape) -> str:
    more = "- [2] Elm. Small Trees. arXiv 2002.\n- [3] Ash. Other things. In *X*, 2003." if shape[1] == "1" else '<span id="page-4-1"></span>C. Elm. 2002. Small trees of it. In X.\n<span id="page-4-2"></span>C. Ash. 2003. Other things of it. In X.'
    return f"# T\n\n## 1 Intro\n\nFirst of ~ it is. We follow {shape[2]} here. Last one.\n\n## References\n\n{shape[0]}\n{more}\n"


#: The year is the first 19xx or 20xx of the entry, be it part of the number in the title of shapes 0, 1 and 3.
_ALT_YEAR = "(CASE WHEN o_orderkey % 5 IN (0, 1, 3) THEN coalesce(nullif(regexp_extract(o_orderkey::VARCHAR, '19[0-9][0-9]|20[0-9][0-9]'), ''), {0}) ELSE {0} END)"


@_query(_expected(_ALT_SHAPES, "b0", lambda x: x[1], lambda x: f"First of ~ it is. We follow {x[3]} here. Last one.", _ALT_YEAR))
def q_alt_contexts(spark, sf_dir):
    return _parsed(spark, sf_dir, "alt", _case(_ALT_SHAPES, _alt, True))
