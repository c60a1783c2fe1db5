"""All queries of the core, by name, and the SQL that gives the same rows.

Every query reads whole tables. A query without SQL is tested against a plain version on small fixtures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeflow.functions import text as T
from tomeflow.operators import chunking, clean, glossary, search, state, store
from tomeflow.sources.files import decoded
from tomeflow.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Every so many ids a row of a table is a query of the searches.
ASKED_EVERY = 50


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _docs(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return table(spark, folder, "documents", *(columns or ("doc_id", "text")))


def _in(values: tuple[str, ...]) -> str:
    return ", ".join("'" + v + "'" for v in values)


# -- files and text ------------------------------------------------------------------------------------------


@_query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def content_hash(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", F.sha2("text", 256).alias("sha256"))


_EXT = r"lower(regexp_extract(rel_path, '\.([^./\\]+)$', 1))"
_TYPE = f"CASE WHEN {_EXT} IN ('yaml', 'yml') THEN 'yaml' WHEN {_EXT} IN ('ini', 'conf') THEN 'ini' WHEN {_EXT} IN ('sql', 'json', 'toml') THEN {_EXT} ELSE 'doc' END"


@_query(f"SELECT rel_path, sha256, {_EXT} AS extension, CASE WHEN {_EXT} IN ({_in((*T.DOC_EXTENSIONS, *T.CODE_TYPES))}) THEN {_TYPE} ELSE 'skip' END AS reads_as FROM source_file")
def format_dispatch(spark: SparkSession, folder: str) -> DataFrame:
    ext = T.extension("rel_path")
    known = ext.isin(*T.DOC_EXTENSIONS, *T.CODE_TYPES)
    return table(spark, folder, "source_file", "rel_path", "sha256").select("rel_path", "sha256", ext.alias("extension"), F.when(known, T.doc_type(ext)).otherwise("skip").alias("reads_as"))


@_query("SELECT rel_path, sha256, CASE WHEN microsecond(mtime) % 1000000 = 0 THEN strftime(mtime AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S+00:00') ELSE strftime(mtime AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS mtime FROM source_file")
def iso_times(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "source_file", "rel_path", "sha256", "mtime").withColumn("mtime", T.iso_utc("mtime"))


_PUNCT = "[" + T.CJK_PUNCTUATION + "]"
_HEAD = f"substr(text, 1, {T.HEAD})"
_WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_READABLE = f"""coalesce(regexp_matches(text, '[^\\s\\x{{0B}}\\x{{1C}}-\\x{{1F}}\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]')
 AND (length({_HEAD}) - length(regexp_replace({_HEAD}, '{_PUNCT}', '', 'g')) >= 3
      OR {" OR ".join(f"contains({_HEAD}, '{t}')" for t in T.TEMPLATES)}
      OR len(list_filter(regexp_split_to_array({_HEAD}, '{_WS}+'), lambda w: regexp_matches(w, '^[\\x00-\\x7F]{{3,}}$'))) >= 10), false)"""


@_query(f"SELECT chunk_id, {_READABLE} AS readable FROM chunk")
def readability_gate(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunk", "chunk_id", "text").select("chunk_id", T.is_readable("text").alias("readable"))


@_query(f"SELECT chunk_id, length({_HEAD}) - length(regexp_replace({_HEAD}, '{_PUNCT}', '', 'g')) AS marks FROM chunk")
def punctuation_marks(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunk", "chunk_id", "text").select("chunk_id", T.punctuation_count("text").alias("marks"))


@_query(rf"SELECT doc_id, round(CASE WHEN coalesce(length({_HEAD}), 0) = 0 THEN 1.0 ELSE length(regexp_replace({_HEAD}, '[\p{{L}}\p{{N}}\p{{P}}\p{{Z}}]', '', 'g')) / length({_HEAD}) END, 6) AS ratio FROM documents")
def garbled_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", F.round(T.garbled_ratio("text"), 6).alias("ratio"))


@_query("SELECT doc_id, sha256(regexp_replace(text, '(?s)<!--.*?-->', '', 'g')) AS stripped FROM documents")
def strip_html_comments(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", F.sha2(T.strip_comments("text"), 256).alias("stripped"))


@_query(r"SELECT doc_id, sha256(regexp_replace(text, '\n{3,}', e'\n\n', 'g')) AS collapsed FROM documents")
def collapse_newlines(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", F.sha2(T.collapse_newlines("text"), 256).alias("collapsed"))


_LINES = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)"


def _trim(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _or(form: str, values: tuple[str, ...]) -> str:
    return "(" + " OR ".join(form.format(v) for v in values) + ")"


_COVER = f"""SELECT doc_id, line_no::INT AS line_no FROM (SELECT doc_id, line_no, bare, regexp_replace(bare, '{_WS}+', '', 'g') AS packed, regexp_replace(lower(bare), '{_WS}+', ' ', 'g') AS low
FROM (SELECT doc_id, line_no, {_trim("line")} AS bare FROM {_LINES})) WHERE starts_with(packed, '#') AND {_or("starts_with(ltrim(packed, '#'), '{}')", (*T.BOILERPLATE_HEADINGS, *T.SPACED_HEADINGS))}
OR {_or("contains(bare, '{}')", T.BOILERPLATE_WORDS)} OR {_or("contains(packed, '{}')", T.SPACED_WORDS)} OR {_or("starts_with(bare, '{}')", T.BOILERPLATE_STARTS)}
OR regexp_full_match(packed, '第[0-9]+页|—[0-9]+—|-[0-9]+-') OR regexp_full_match(bare, 'Page{_WS}+[0-9]+') OR contains(low, 'all rights reserved') OR contains(low, 'all right reserved')
OR regexp_matches(packed, '©[0-9]{{4}}') OR regexp_matches(packed, '^文档版本[0-9]') OR bare <> '' AND contains('{T.CIRCLED}', substr(bare, 1, 1))"""


@_query(_COVER)
def boilerplate_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = _docs(spark, folder).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    return lines.where(T.is_boilerplate(F.col("line"))).select("doc_id", (F.col("at") + 1).alias("line_no"))


@_query("SELECT doc_id, octet_length(encode(text)) AS bytes, octet_length(encode(text)) > 20 * 1024 AS large FROM documents WHERE text IS NOT NULL")
def size_warning(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).where("text is not null").select("doc_id", F.octet_length("text").alias("bytes"), T.size_warning("text", 20).isNotNull().alias("large"))


@_query(f"SELECT doc_id, sha256(array_to_string(list_transform(string_split(text, chr(10)), lambda l: CASE WHEN regexp_matches(l, '^\\|(\\||{_WS})*\\|{_WS}*$') THEN '' ELSE l END), chr(10))) AS cleaned FROM documents")
def blank_pipe_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", F.sha2(T.drop_blank_rows("text"), 256).alias("cleaned"))


@_query()
def clean_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", clean.clean_markdown("text").alias("markdown"))


# -- chunks --------------------------------------------------------------------------------------------------


@_query("""SELECT doc_id, i::INT AS chunk_index, n::INT AS chunk_total, substr(text, i * 1200 + 1, 1200) AS text
FROM (SELECT doc_id, text, n, unnest(range(0, n)) AS i FROM (SELECT doc_id, text, ceil(length(text) / 1200)::BIGINT AS n FROM documents WHERE length(text) > 0))""")
def hard_slice_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return chunking.hard_slices(_docs(spark, folder), "doc_id", "text")


@_query()
def chunk_documents(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.coalesce(F.lower("doc_type"), T.doc_type(T.extension("rel_path")))
    docs = _docs(spark, folder, "rel_path", "doc_type", "text")
    return chunking.chunk(docs.select(F.col("rel_path").alias("source"), F.sha2("text", 256).alias("file_hash"), kind.alias("doc_type"), "text"))


_PIECES = "SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY g) - 1)::INT AS at, sha256(piece) AS piece FROM pieces"
_OF = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE lower(doc_type) IN ({}))"
_JOINED = "pieces AS (SELECT * FROM (SELECT doc_id, g, string_agg(line, chr(10) ORDER BY i) AS piece FROM groups GROUP BY doc_id, g) WHERE " + _trim("piece") + " <> '')"


def _pieces(spark: SparkSession, folder: str, kind: str, *kinds: str) -> DataFrame:
    docs = _docs(spark, folder, "doc_id", "text", "doc_type").where(F.lower("doc_type").isin(*(kinds or (kind,))))
    return docs.select("doc_id", F.posexplode(chunking.pieces_of("text", kind)).alias("at", "piece")).select("doc_id", "at", F.sha2("piece", 256).alias("piece"))


@_query(f"""WITH {_OF.format("'ini', 'toml'")}, groups AS (SELECT *, sum(regexp_full_match(line, '{_WS}*\\[.+\\]{_WS}*')::INT) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM lines), {_JOINED} {_PIECES}""")
def ini_sections(spark: SparkSession, folder: str) -> DataFrame:
    return _pieces(spark, folder, "ini", "ini", "toml")


@_query(f"""WITH {_OF.format("'yaml'")}, groups AS (SELECT *, greatest(sum(regexp_matches(line, '^[A-Za-z0-9_.\\-]+{_WS}*:')::INT) OVER (PARTITION BY doc_id ORDER BY i), 1) AS g FROM lines), {_JOINED} {_PIECES}""")
def yaml_keys(spark: SparkSession, folder: str) -> DataFrame:
    return _pieces(spark, folder, "yaml")


# what hides a semicolon is one token, and so is a run without any sign that matters
_TOKENS = r"(?s)'(?:[^']|'')*'|--[^\n]*|/\*.*?\*/|[^'\-/;]+|."


@_query(f"""WITH toks AS (SELECT doc_id, unnest(t) AS tok, generate_subscripts(t, 1) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{_TOKENS.replace("'", "''")}') AS t FROM documents WHERE lower(doc_type) = 'sql')),
groups AS (SELECT *, coalesce(sum((tok = ';')::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM toks),
pieces AS (SELECT * FROM (SELECT doc_id, g, {_trim("string_agg(tok, '' ORDER BY i)")} AS piece FROM groups GROUP BY doc_id, g) WHERE piece <> '') {_PIECES}""")
def sql_statements(spark: SparkSession, folder: str) -> DataFrame:
    return _pieces(spark, folder, "sql")


@_query("""SELECT doc_id, (generate_subscripts(json_keys(text), 1) - 1)::INT AS at, unnest(json_keys(text)) AS key, unnest(list_transform(json_keys(text), lambda k: json_type(json_extract(text, '$."' || k || '"')))) AS kind
FROM documents WHERE lower(doc_type) = 'json' AND json_valid(text) AND json_type(text) = 'OBJECT'""")
def json_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The keys that the pieces hold, one each, and the kinds of their values."""
    docs = _docs(spark, folder, "doc_id", "text", "doc_type").where((F.lower("doc_type") == "json") & (F.size(F.json_object_keys("text")) > 0))
    pieces = docs.select("doc_id", F.posexplode(chunking.pieces_of("text", "json")).alias("at", "piece"))
    key, value = F.json_object_keys("piece")[0], F.regexp_extract("piece", r'(?s)\A\{\s*"(?:[^"\\]|\\.)*":\s*(.)', 1)
    number = F.when(F.regexp_extract("piece", r'(?s)\A\{\s*"(?:[^"\\]|\\.)*":\s*(-?[0-9.eE+\-]+)', 1).rlike("[.eE]"), "DOUBLE").when(value == "-", "BIGINT").otherwise("UBIGINT")
    kind = F.when(value == "{", "OBJECT").when(value == "[", "ARRAY").when(value == '"', "VARCHAR").when(value.isin("t", "f"), "BOOLEAN").when(value == "n", "NULL").otherwise(number)
    return pieces.select("doc_id", "at", key.alias("key"), kind.alias("kind"))


@_query("SELECT doc_id, '.' || lower(doc_type) AS marker, sha256(text) AS text FROM documents WHERE lower(doc_type) <> 'doc'")
def marker_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Code marked as the converter marks it, and taken out of its fence again."""
    docs = _docs(spark, folder, "doc_id", "text", "doc_type").where(F.lower("doc_type") != "doc")
    kind = F.lower("doc_type")
    marked = docs.select("doc_id", F.concat(F.lit("<!-- x:source_ext=."), kind, F.lit(" -->\n```"), kind, F.lit("\n"), "text", F.lit("\n```\n")).alias("marked"), kind.alias("kind"))
    return marked.select("doc_id", F.coalesce(T.source_marker("marked"), F.concat(F.lit("."), "kind")).alias("marker"), F.sha2(T.strip_marker("marked"), 256).alias("text"))


@_query(f"SELECT doc_id, sha256(text) AS decoded, 'utf-8' AS encoding FROM documents WHERE {_trim('text')} <> ''")
def decoded_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The bytes of every text that isn't blank, decoded again."""
    rows = _docs(spark, folder).where(~T.is_blank("text")).select("doc_id", decoded(F.encode("text", "UTF-8")).alias("d"))
    return rows.select("doc_id", F.sha2("d.text", 256).alias("decoded"), "d.encoding")


_KEY = ["source", "file_hash", "chunk_index"]


@_query("SELECT source, file_hash, chunk_index, arg_max(chunk_id, (coalesce(ingested_at, TIMESTAMPTZ '1900-01-01'), chunk_id)) AS chunk_id, count(*) AS stored FROM chunk GROUP BY ALL")
def current_chunks(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "chunk", "chunk_id", *_KEY, "ingested_at")
    return rows.groupBy(*_KEY).agg(F.max(F.struct("ingested_at", "chunk_id"))["chunk_id"].alias("chunk_id"), F.count("*").alias("stored"))


@_query("SELECT source, file_hash, coalesce(lower(doc_type), 'doc') AS doc_type, count(*) AS chunks, sum(length(text)) AS chars, max(chunk_total) AS chunk_total FROM chunk GROUP BY ALL")
def chunk_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "chunk", "source", "file_hash", "doc_type", "chunk_total", "text")
    return rows.groupBy("source", "file_hash", F.coalesce(F.lower("doc_type"), F.lit("doc")).alias("doc_type")).agg(F.count("*").alias("chunks"), F.sum(F.length("text")).alias("chars"), F.max("chunk_total").alias("chunk_total"))


# -- retrieval -----------------------------------------------------------------------------------------------


@_query("""WITH q AS (SELECT vec_id AS query_id, embedding FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT query_id, e.vec_id, round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 4) AS sim FROM q, embeddings e)
SELECT query_id, vec_id, sim, (row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id))::INT AS place FROM s QUALIFY place <= 20""")
def vector_topk(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings", "vec_id", "embedding").withColumnRenamed("embedding", "vector")
    asked = rows.where(F.col("vec_id") % ASKED_EVERY == 0).withColumnRenamed("vec_id", "query_id")
    return search.vector_topk(rows, asked, "vec_id", "query_id", 20)


_TERMS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"
_BUCKET = "('0x' || substr(md5(term), 1, 4))::INT % 256"


@_query(f"""WITH t AS (SELECT doc_id, unnest({_TERMS.format("text")}) AS term FROM documents)
SELECT doc_id, {_BUCKET} AS bucket, count(*) AS w FROM t GROUP BY ALL""")
def hashed_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return search.hashed_vectors(search.postings(_docs(spark, folder), "doc_id", "text"), "doc_id")


@_query(f"""WITH t AS (SELECT doc_id, unnest({_TERMS.format("text")}) AS term FROM documents), p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL)
SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM p GROUP BY term""")
def term_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return search.postings(_docs(spark, folder), "doc_id", "text").groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


@_query(f"""WITH t AS (SELECT chunk_id, unnest({_TERMS.format("text")}) AS term FROM chunk), p AS (SELECT chunk_id, term, count(*) AS tf FROM t GROUP BY ALL)
SELECT chunk_id, sum(tf)::BIGINT AS length, count(*) AS terms FROM p GROUP BY chunk_id""")
def index_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """What the index holds of each text: its length in terms, as every posting has it, and its distinct terms."""
    index = search.build_index(table(spark, folder, "chunk", "chunk_id", "text"), "chunk_id", "text")
    return index.postings.groupBy("chunk_id").agg(F.max("dl").alias("length"), F.count("*").alias("terms"))


def _questions(spark: SparkSession, folder: str, every: int = ASKED_EVERY) -> DataFrame:
    """The stated query set, each question once, expanded by the glossary."""
    rows = table(spark, folder, "query_log", "query_id", "question").where(F.col("query_id") % every == 0).distinct()
    return glossary.expand(rows, table(spark, folder, "glossary"))


# a term counts where no letter, digit or underscore stands next to it
_FOUND = r"(CASE WHEN NOT contains(lower(question), lower(term)) THEN false WHEN regexp_matches(term, '^[\x00-\x7F]*$') THEN regexp_matches(lower(question), '(^|[^\p{L}\p{N}_])' || regexp_replace(lower(term), '([^\p{L}\p{N} ])', '\\\1', 'g') || '($|[^\p{L}\p{N}_])') ELSE contains(lower(question), lower(term)) END)"
_EXPANDED = f"""names AS (SELECT term, n, row_number() OVER (ORDER BY term, pos) AS nth FROM (
  SELECT term, full AS n, 0 AS pos FROM glossary UNION ALL SELECT term, unnest(aliases) AS n, generate_subscripts(aliases, 1) AS pos FROM glossary)
  WHERE n IS NOT NULL AND trim(n) <> '' AND lower(n) <> lower(term)),
added AS (SELECT query_id, question, n, min(nth) AS nth FROM asked, names WHERE {_FOUND} GROUP BY ALL),
expanded AS (SELECT a.query_id, a.question, CASE WHEN a.question IS NULL THEN NULL ELSE a.question || coalesce((SELECT string_agg(' ' || n, '' ORDER BY nth) FROM added d WHERE d.query_id = a.query_id AND d.question = a.question), '') END AS expanded FROM asked a)"""


@_query("WITH asked AS (SELECT DISTINCT query_id, question FROM query_log), " + _EXPANDED.replace("full", '"full"') + " SELECT query_id, question, expanded FROM expanded")
def glossary_expand(spark: SparkSession, folder: str) -> DataFrame:
    return glossary.expand(table(spark, folder, "query_log", "query_id", "question").distinct(), table(spark, folder, "glossary"))


_INDEX = f"""asked AS (SELECT DISTINCT query_id, question FROM query_log WHERE query_id % 50 = 0), {_EXPANDED.replace("full", '"full"')},
tok AS (SELECT chunk_id, unnest({_TERMS.format("text")}) AS term FROM chunk), tf AS (SELECT chunk_id, term, count(*) AS tf FROM tok GROUP BY ALL),
dl AS (SELECT chunk_id, sum(tf) AS dl FROM tf GROUP BY ALL), st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl), df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL),
qtok AS (SELECT query_id, unnest({_TERMS.format("expanded")}) AS term FROM expanded), qtf AS (SELECT query_id, term, count(*) AS tf FROM qtok GROUP BY ALL),
scored AS (SELECT query_id, chunk_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf.tf * 2.2 / (tf.tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score FROM qtf JOIN tf USING (term) JOIN df USING (term) JOIN dl USING (chunk_id), st GROUP BY ALL),
bm AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id))::INT AS place FROM scored QUALIFY place <= 15)"""


@_query(f"WITH {_INDEX} SELECT query_id, chunk_id, score, place FROM bm")
def bm25_topk(spark: SparkSession, folder: str) -> DataFrame:
    index = search.postings(table(spark, folder, "chunk", "chunk_id", "text"), "chunk_id", "text")
    asked = search.postings(_questions(spark, folder).where("expanded is not null"), "query_id", "expanded")
    return search.bm25(index, asked.select("query_id", "term"), "chunk_id", "query_id", 15)


_HITS = f"""{_INDEX},
h AS (SELECT chunk_id, {_BUCKET} AS bucket, sum(tf)::DOUBLE AS w FROM tf GROUP BY ALL), hn AS (SELECT chunk_id, sqrt(sum(w * w)) AS norm FROM h GROUP BY ALL),
qh AS (SELECT query_id, {_BUCKET} AS bucket, sum(tf)::DOUBLE AS w FROM qtf GROUP BY ALL), qn AS (SELECT query_id, sqrt(sum(w * w)) AS norm FROM qh GROUP BY ALL),
dots AS (SELECT query_id, chunk_id, sum(h.w * qh.w) AS dot FROM h JOIN qh USING (bucket) GROUP BY ALL),
sims AS (SELECT q.query_id, c.chunk_id, round(coalesce(dot, 0) / (q.norm * c.norm), 4) AS sim FROM qn q CROSS JOIN hn c LEFT JOIN dots USING (query_id, chunk_id)),
near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, chunk_id) AS place FROM sims QUALIFY place <= 20),
both_lists AS (SELECT query_id, chunk_id, place FROM bm UNION ALL SELECT query_id, chunk_id, place FROM near WHERE place <= 15),
rrf AS (SELECT query_id, chunk_id, round(sum(1e0 / (60 + place)), 8) AS rrf FROM both_lists GROUP BY ALL),
fused AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, chunk_id) AS p FROM rrf QUALIFY p <= 15),
hits AS (SELECT query_id, chunk_id, rrf, sim, (row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, chunk_id))::INT AS place, CASE WHEN sim IS NULL THEN 'keyword' ELSE 'hybrid' END AS matched_by
  FROM fused LEFT JOIN near USING (query_id, chunk_id) WHERE sim IS NULL OR sim >= 0.5 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, chunk_id) <= 5)"""


def _hits(spark: SparkSession, folder: str, every: int = ASKED_EVERY) -> tuple[DataFrame, DataFrame, DataFrame]:
    chunks = table(spark, folder, "chunk", "chunk_id", "text", "source", "doc_type")
    questions = _questions(spark, folder, every)
    return questions, search.hybrid_hits(questions, search.build_index(chunks, "chunk_id", "text")), chunks


def all_hits(spark: SparkSession, folder: str) -> DataFrame:
    """The hits of every logged question."""
    return _hits(spark, folder, 1)[1].select("query_id", "chunk_id", "rrf", "sim", "place", "matched_by")


@_query(f"WITH {_HITS} SELECT query_id, chunk_id, rrf, sim, place, matched_by FROM hits")
def hybrid_search(spark: SparkSession, folder: str) -> DataFrame:
    return _hits(spark, folder)[1].select("query_id", "chunk_id", "rrf", "sim", "place", "matched_by")


_GRADED = f"""{_HITS},
best AS (SELECT query_id, arg_min(sim, place) FILTER (sim IS NOT NULL) AS best, count(*) AS n FROM hits GROUP BY ALL),
graded AS (SELECT query_id, question, expanded, coalesce(n, 0)::INT AS hits, best, CASE WHEN coalesce(n, 0) = 0 THEN 'low' WHEN best IS NULL THEN 'medium' WHEN best >= 0.75 THEN 'high' WHEN best >= 0.55 THEN 'medium' ELSE 'low' END AS confidence FROM expanded LEFT JOIN best USING (query_id))"""


@_query(f"""WITH {_GRADED} SELECT query_id, question AS query, CASE WHEN expanded <> question THEN expanded END AS expanded_query, hits > 0 AS found, hits, best AS best_similarity, confidence,
CASE WHEN question IS NULL OR NOT regexp_matches(question, '[^\\s\\x{{A0}}\\x{{3000}}]') THEN 'empty question' END AS error FROM graded""")
def hybrid_batch(spark: SparkSession, folder: str) -> DataFrame:
    return search.answers(*_hits(spark, folder), "chunk_id").drop("results")


@_query(f"WITH {_GRADED} SELECT confidence, count(*) AS questions, sum(hits)::BIGINT AS hits FROM graded GROUP BY ALL")
def confidence_summary(spark: SparkSession, folder: str) -> DataFrame:
    return search.answers(*_hits(spark, folder), "chunk_id").groupBy("confidence").agg(F.count("*").alias("questions"), F.sum("hits").alias("hits"))


_TOLD = f"""{_GRADED}, told AS (SELECT query_id, place, {_trim("c.text")} AS text, regexp_extract(c.source, '([^/\\\\]*)$', 1) AS file_name, c.source, sim, matched_by, coalesce(lower(c.doc_type), 'doc') AS doc_type FROM hits JOIN chunk c USING (chunk_id))"""


@_query(f"WITH {_TOLD} SELECT query_id, place, sha256(text) AS text, file_name, source, sim, matched_by, doc_type FROM told")
def hybrid_results(spark: SparkSession, folder: str) -> DataFrame:
    """The results of the answers, one row each."""
    rows = search.answers(*_hits(spark, folder), "chunk_id").select("query_id", F.inline("results"))
    return rows.withColumn("text", F.sha2("text", 256))


@_query(f"""WITH {_TOLD}, blocks AS (SELECT query_id, string_agg('【知识片段 ' || place || '】📄 ' || file_name || ' (相关度: ' || CASE WHEN sim IS NULL THEN '关键词命中' ELSE printf('%.2f%%', sim * 100) END || ')' || chr(10) ||
  CASE WHEN length(text) > 2000 THEN substr(text, 1, 2000) || '...(截断)' ELSE text END, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY place) AS context FROM told GROUP BY query_id)
SELECT query_id, CASE WHEN hits = 0 THEN '[知识库检索无结果]' ELSE context END AS context FROM graded LEFT JOIN blocks USING (query_id)""")
def context_render(spark: SparkSession, folder: str) -> DataFrame:
    return search.as_context(search.answers(*_hits(spark, folder), "chunk_id"))


# -- state and reports ---------------------------------------------------------------------------------------

_STATE = ("rel_path", "sha256", "size", "mtime", "abs_source_path", "conversion", "ingestion", "recorded_at")


def _states(spark: SparkSession, folder: str) -> DataFrame:
    """The last record of every file, whichever version it is of."""
    rows = table(spark, folder, "pipeline_state", *_STATE)
    return state.latest(rows, ["rel_path"], ["recorded_at", "sha256"])


_LAST = "last_state AS (SELECT rel_path, unnest(arg_max(s, (recorded_at, sha256))) FROM (SELECT rel_path, recorded_at, sha256, {'sha256': sha256, 'cs': coalesce(conversion.status, 'pending'), 'ce': conversion.error, 'ins': coalesce(ingestion.status, 'pending'), 'ie': ingestion.error} AS s FROM pipeline_state WHERE rel_path IS NOT NULL AND recorded_at IS NOT NULL) GROUP BY rel_path)"
_DIFF = "CASE WHEN o.rel_path IS NULL THEN 'new' WHEN o.sha256 IS DISTINCT FROM f.sha256 THEN 'changed' WHEN cs IN ('ok', 'skip') AND ins IN ('ok', 'skip') THEN 'skip' WHEN cs IN ('ok', 'skip') THEN 'retry_ingest' ELSE 'retry' END"


@_query(f"""WITH {_LAST} SELECT rel_path, sha256, reason, CASE reason WHEN 'skip' THEN 'skip' WHEN 'retry_ingest' THEN 'ingest' ELSE 'convert' END AS action
FROM (SELECT f.rel_path, f.sha256, {_DIFF} AS reason FROM source_file f LEFT JOIN last_state o ON f.rel_path = o.rel_path)""")
def incremental_diff(spark: SparkSession, folder: str) -> DataFrame:
    return state.plan(table(spark, folder, "source_file", "rel_path", "sha256"), _states(spark, folder))


@_query(f"WITH {_LAST} SELECT reason, count(*) AS files FROM (SELECT {_DIFF} AS reason FROM source_file f LEFT JOIN last_state o ON f.rel_path = o.rel_path) GROUP BY reason")
def queue_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return incremental_diff(spark, folder).groupBy("reason").agg(F.count("*").alias("files"))


_STAGES = f"""{_LAST}, stages AS (SELECT rel_path, 'conversion' AS stage, cs AS status, ce AS error FROM last_state UNION ALL SELECT rel_path, 'ingestion', ins, ie FROM last_state)"""


@_query(f"WITH {_STAGES} SELECT stage, count(*) AS total, " + ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in state.STATUSES) + " FROM stages GROUP BY stage")
def status_summary(spark: SparkSession, folder: str) -> DataFrame:
    return state.summary(_states(spark, folder))


@_query(f"WITH {_STAGES} SELECT rel_path, stage, status, error FROM stages WHERE status IN ({_in(state.RETRY)})")
def failed_files(spark: SparkSession, folder: str) -> DataFrame:
    return state.failed(_states(spark, folder))


@_query(f"""WITH {_STAGES}, f AS (SELECT stage, substr(coalesce(error, status), 1, 100) AS reason, rel_path, row_number() OVER (PARTITION BY stage, substr(coalesce(error, status), 1, 100) ORDER BY rel_path) AS k FROM stages WHERE status IN ({_in(state.RETRY)}))
SELECT stage, reason, count(*) AS n, string_agg(rel_path, ', ' ORDER BY rel_path) FILTER (k <= 5) AS examples FROM f GROUP BY ALL""")
def failed_by_error(spark: SparkSession, folder: str) -> DataFrame:
    return state.failures_by_error(_states(spark, folder))


@_query(f"WITH {_LAST} SELECT rel_path, CASE WHEN cs IN ('ok', 'skip') THEN cs ELSE 'pending' END AS conversion, CASE WHEN ins IN ('ok', 'skip') THEN ins ELSE 'pending' END AS ingestion FROM last_state")
def state_reset(spark: SparkSession, folder: str) -> DataFrame:
    again = state.reset(_states(spark, folder))
    return again.select("rel_path", state.status("conversion").alias("conversion"), state.status("ingestion").alias("ingestion"))


_VERSION = "files AS (SELECT rel_path, unnest(arg_max(v, (mtime, sha256))) FROM (SELECT rel_path, mtime, sha256, {'sha256': sha256, 'size': size} AS v FROM source_file WHERE rel_path IS NOT NULL) GROUP BY rel_path)"


def _versions(spark: SparkSession, folder: str) -> DataFrame:
    """The last version of every file."""
    return state.latest(table(spark, folder, "source_file", "rel_path", "sha256", "size", "mtime"), ["rel_path"], ["mtime", "sha256"]).withColumn("abs_source_path", F.col("rel_path"))


@_query(f"""WITH {_LAST}, {_VERSION} SELECT coalesce(f.rel_path, o.rel_path) AS rel_path, coalesce(f.sha256, o.sha256) AS sha256, CASE WHEN f.rel_path IS NULL OR f.sha256 = o.sha256 THEN cs ELSE 'pending' END AS conversion, CASE WHEN f.rel_path IS NULL OR f.sha256 = o.sha256 THEN ins ELSE 'pending' END AS ingestion
FROM files f FULL JOIN last_state o ON f.rel_path = o.rel_path""")
def state_start(spark: SparkSession, folder: str) -> DataFrame:
    """The state after a scan."""
    now = state.start(_versions(spark, folder), _states(spark, folder).drop("recorded_at"))
    return now.select("rel_path", "sha256", state.status("conversion").alias("conversion"), state.status("ingestion").alias("ingestion"))


@_query(f"""WITH {_LAST}, {_VERSION} SELECT rel_path, CASE WHEN f.sha256 IS NULL THEN cs WHEN size = 0 THEN 'empty' ELSE 'ok' END AS conversion, ins AS ingestion FROM last_state o LEFT JOIN files f USING (rel_path)""")
def state_record(spark: SparkSession, folder: str) -> DataFrame:
    """The state with the results of a conversion, by the sizes of the files."""
    results = _versions(spark, folder).select("rel_path", F.when(F.col("size") == 0, "empty").otherwise("ok").alias("status"), F.lit(None).cast("string").alias("md_path"), F.lit(None).cast("string").alias("error"))
    now = state.record(_states(spark, folder).drop("recorded_at"), results, "conversion")
    return now.select("rel_path", state.status("conversion").alias("conversion"), state.status("ingestion").alias("ingestion"))


@_query(f"WITH {_LAST} SELECT rel_path, sha256 FROM last_state WHERE rel_path NOT IN (SELECT rel_path FROM source_file WHERE rel_path IS NOT NULL AND size = 0)")
def state_remove(spark: SparkSession, folder: str) -> DataFrame:
    """The state without the files that have an empty version."""
    gone = table(spark, folder, "source_file", "rel_path", "size").where("size = 0")
    return state.remove(_states(spark, folder), gone).select("rel_path", "sha256")


@_query("SELECT question, arg_min(query_id, (asked_at, query_id)) AS query_id, min(epoch(asked_at))::BIGINT AS asked_s, count(*) AS n FROM query_log WHERE asked_at IS NOT NULL GROUP BY question")
def dedup_queue(spark: SparkSession, folder: str) -> DataFrame:
    """Each question once, as it was asked first."""
    rows = table(spark, folder, "query_log", "query_id", "question", "asked_at").where("asked_at is not null")
    return state.first_wins(rows, ["question"], ["asked_at", "query_id"]).select("question", "query_id", F.unix_timestamp("asked_at").alias("asked_s"), "n")


@_query("SELECT count(*) AS total_chunks, count(DISTINCT source) AS file_count FROM chunk")
def kb_stats(spark: SparkSession, folder: str) -> DataFrame:
    return store.stats(table(spark, folder, "chunk", "source"))


@_query("SELECT source, count(*) AS chunks FROM chunk GROUP BY source")
def kb_sources(spark: SparkSession, folder: str) -> DataFrame:
    return store.sources(table(spark, folder, "chunk", "source"))


_NEW = "SELECT rel_path, sha256 FROM (SELECT *, row_number() OVER (PARTITION BY rel_path ORDER BY mtime DESC, sha256 DESC) AS r FROM source_file) WHERE r = 1"


@_query(f"""WITH v AS ({_NEW}) SELECT c.chunk_id, c.source, c.file_hash FROM chunk c LEFT JOIN v ON c.source = v.rel_path WHERE v.rel_path IS NULL OR v.sha256 = c.file_hash""")
def upsert_kb(spark: SparkSession, folder: str) -> DataFrame:
    """The chunks with those of replaced file versions replaced by the last version's."""
    chunks = table(spark, folder, "chunk", "chunk_id", "source", "file_hash")
    files = table(spark, folder, "source_file", "rel_path", "sha256", "mtime")
    last = files.groupBy("rel_path").agg(F.max(F.struct("mtime", "sha256"))["sha256"].alias("file_hash")).withColumnRenamed("rel_path", "source")
    new = chunks.join(last, ["source", "file_hash"], "left_semi").select(*chunks.columns)
    return store.replaced(chunks, new, gone=last)


_ONE = "(SELECT min(source) FROM chunk)"
_FIRST = "(SELECT min(space) FROM kb_space)"


def _bounds(spark: SparkSession, folder: str) -> tuple[str, str]:
    source = table(spark, folder, "chunk", "source").agg(F.min("source")).first()[0]
    return source, table(spark, folder, "kb_space", "space").agg(F.min("space")).first()[0] + "/"


@_query(f"SELECT chunk_id, source FROM chunk WHERE coalesce(source <> {_ONE}, true)")
def delete_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunk", "chunk_id", "source").where(~store.doomed(source=_bounds(spark, folder)[0]))


@_query(f"SELECT chunk_id, source FROM chunk WHERE coalesce(NOT starts_with(source, {_FIRST} || '/'), true)")
def delete_by_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunk", "chunk_id", "source").where(~store.doomed(prefix=_bounds(spark, folder)[1]))


@_query(f"SELECT count(DISTINCT source) AS sources, count(*) AS chunks FROM chunk WHERE starts_with(source, {_FIRST} || '/')")
def delete_preview(spark: SparkSession, folder: str) -> DataFrame:
    return store.impact(table(spark, folder, "chunk", "source"), store.doomed(prefix=_bounds(spark, folder)[1]))


def _domain(c: Column) -> Column:
    return F.split_part(c, F.lit("/"), F.lit(1))


@_query("SELECT coalesce(s.domain, 'unknown') AS domain, count(DISTINCT c.source) AS files, count(*) AS chunks, sum(length(c.text)) AS chars FROM chunk c LEFT JOIN kb_space s ON split_part(c.source, '/', 1) = s.space GROUP BY ALL")
def domain_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks by domain: counted by source first, so that a source with many chunks is one row of the join."""
    rows = table(spark, folder, "chunk", "source", "text").groupBy("source").agg(F.count("*").alias("chunks"), F.sum(F.length("text")).alias("chars"))
    space = table(spark, folder, "kb_space", "space", "domain")
    joined = rows.withColumn("space", _domain(F.col("source"))).join(space, "space", "left")
    return joined.groupBy(F.coalesce("domain", F.lit("unknown")).alias("domain")).agg(F.count("source").alias("files"), F.sum("chunks").alias("chunks"), F.sum("chars").alias("chars"))
