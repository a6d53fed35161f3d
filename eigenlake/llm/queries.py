"""Registered queries of this subpackage, each over a whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eigenlake.llm.conversation_repair import damaged, repair_report
from eigenlake.llm.decontaminate import contaminated
from eigenlake.llm.embedding_dedup import near_vectors
from eigenlake.llm.exact_dedup import exact_groups
from eigenlake.llm.html_text import extract_text
from eigenlake.llm.lexical_search import search
from eigenlake.llm.line_dedup import repeated_lines
from eigenlake.llm.minhash_dedup import near_duplicates
from eigenlake.llm.mixing import mix
from eigenlake.llm.secrets import find_secrets
from eigenlake.llm.staging import Staging
from eigenlake.llm.token_counts import count_tokens
from eigenlake.llm.toxicity import fit_toxicity, score_documents
from eigenlake.llm.warc import page_digests

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Lower-cased words of a text column in DuckDB.
def words_sql(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lower}, '[^\\x20\\x09-\\x0D]+')"


@query(
    "op5_near_duplicates",
    f"""WITH RECURSIVE w AS (SELECT doc_id, {words_sql('text')} AS w FROM documents),
    sets AS (SELECT doc_id, list_distinct(list_transform(
        CASE WHEN len(w) = 0 THEN [] ELSE range(1, greatest(len(w) - 4, 1) + 1) END,
        lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS s FROM w),
    items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
    shared AS (SELECT a.doc_id AS u, b.doc_id AS v, a.n + b.n AS total, count(*) AS common
        FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY 1, 2, 3),
    links AS (SELECT u, v FROM shared WHERE 100 * common >= 85 * (total - common)),
    reach AS (SELECT doc_id AS u, doc_id AS v FROM documents
        UNION SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.v)
    SELECT s.doc_id, len(s) AS n_shingles, min(v) AS component_id, min(v) = s.doc_id AS kept
    FROM sets s JOIN reach ON reach.u = s.doc_id GROUP BY s.doc_id, s""",
)
def op5_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), threshold_percent=85)


MIX_SQL = """WITH d AS (SELECT doc_id, source,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size,
        row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
    w AS (SELECT *, [3, 1, 2][(rank - 1) % 3 + 1] AS weight FROM s),
    f AS (SELECT *, (sum(source_size) OVER () * 3 / 2.0
        - (sum(2 * source_size) OVER o - 2 * source_size))
        / (sum(weight) OVER () - (sum(weight) OVER o - weight)) AS level FROM w
        WINDOW o AS (ORDER BY 2 * source_size / weight, rank)),
    t AS (SELECT *, least(2.0 * source_size, weight * max(level) OVER ())::DOUBLE AS target FROM f),
    p AS (SELECT d.doc_id, d.size, t.source_size::BIGINT AS source_size, t.target, sum(d.size) OVER
        (PARTITION BY t.rank ORDER BY md5('17:' || d.doc_id), d.doc_id)::BIGINT AS words
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
        (greatest(0, least(size, floor(target)::BIGINT - (words - size)))
        + greatest(0, least(size, floor(target)::BIGINT - (source_size + words - size))))::BIGINT AS taken FROM p"""


@query("op2_mix_sources", MIX_SQL)
def op2_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = score_documents(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", "held_out", "score", "predicted", "n_passages")


@query("op9_decontaminate")
def op9_decontaminate(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_line_dedup")
def op7_line_dedup(spark, sf_dir):
    found = repeated_lines(table(spark, sf_dir, "documents"), least_words=1)
    return found.select("doc_id", "line_no", "kept_doc_id", "kept_line_no")


@query(
    "op4_embedding_dedup",
    """WITH RECURSIVE links AS (SELECT a.vec_id AS u, b.vec_id AS v
        FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.93),
    reach AS (SELECT vec_id AS u, vec_id AS v FROM embeddings
        UNION SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.v)
    SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.u = e.vec_id) AS n_links,
        min(v) AS component_id, min(v) = e.vec_id AS kept
    FROM embeddings e JOIN reach ON reach.u = e.vec_id GROUP BY e.vec_id""",
)
def op4_embedding_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op10_html_text")
def op10_html_text(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages"))


@query(
    "op6_warc",
    """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS n, sha256(html) AS h FROM p),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
    SELECT page_id, n AS payload_bytes, h AS payload_digest,
        CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to FROM f""",
)
def op6_warc(spark, sf_dir):
    return page_digests(table(spark, sf_dir, "pages"), f"{Staging(spark, 'warc').root}/archives")


@query("op3_secrets")
def op3_secrets(spark, sf_dir):
    return find_secrets(table(spark, sf_dir, "documents"))


@query("op1_token_counts")
def op1_token_counts(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"))


@query(
    "op11_exact_duplicates",
    """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
)
def op11_exact_duplicates(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))


# Terms of a text column in DuckDB, with A-Z lower-cased.
def terms_sql(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"unnest(regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"


@query(
    "op12_ranked_search",
    f"""WITH t AS (SELECT doc_id, {terms_sql('text')} AS term FROM documents),
    q AS (SELECT item_id, term, count(*) AS repeats
        FROM (SELECT item_id, {terms_sql('text')} AS term FROM benchmark) GROUP BY 1, 2),
    total AS (SELECT count(DISTINCT doc_id) AS n, count(*) AS length FROM t),
    d AS (SELECT doc_id, 25 + (75 * count(*) * any_value(total.n)) // any_value(total.length) AS m FROM t, total GROUP BY 1),
    f AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY 1, 2),
    w AS (SELECT term, floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, total GROUP BY 1),
    s AS (SELECT item_id, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
        FROM q JOIN f USING (term) JOIN w USING (term) JOIN d USING (doc_id) GROUP BY 1, 2)
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
    FROM s WHERE score > 0 QUALIFY rank <= 10""",
)
def op12_ranked_search(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Damage by CRC-32 of the key, then the cheapest way through rows x what has been accepted, step by step.
REPAIR_SQL = r"""WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(4294967295, list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':'
                || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT),
            lambda crc, b: list_reduce(range(8), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END),
                xor(crc, b)), 4294967295)) % 20 AS kind FROM conversations),
    d AS (SELECT conv_id, turn, copy, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM k, (VALUES (0), (1)) AS c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
    n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
        regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending, left(role, 1) AS initial FROM d),
    f AS (SELECT *, lag(initial) OVER w || initial AS neighbours,
        CASE WHEN ending = '' THEN 2 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 3
            WHEN ending NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault
        FROM n WINDOW w AS (PARTITION BY conv_id ORDER BY n)),
    -- States: 0 nothing, 1 a system turn, 2 a turn of the user, 3 a whole pair.
    nodes AS (SELECT DISTINCT conv_id, 0::BIGINT AS n, 0 AS state,
            {'cost': 0::BIGINT, 'audit': '', 'turns': []::VARCHAR[]} AS best FROM f
        UNION ALL
        SELECT conv_id, n, state, min(best) FROM (
            SELECT f.conv_id, f.n, e.state, {'cost': (m.cost + e.price + CASE e.edit WHEN 'D' THEN 0 ELSE fault END)::BIGINT,
                'audit': m.audit || e.edit, 'turns': CASE e.edit WHEN 'D' THEN m.turns
                    WHEN 'K' THEN list_append(m.turns, role || ':' || text)
                    ELSE list_append(m.turns, CASE m.state WHEN 2 THEN 'assistant:' ELSE 'user:' END || text) END} AS best
            FROM (SELECT conv_id, n, state, best.cost AS cost, best.audit AS audit, best.turns AS turns FROM nodes
                UNION ALL
                SELECT conv_id, n, CASE state WHEN 2 THEN 3 ELSE 2 END, best.cost + 2, best.audit || 'I',
                    list_append(best.turns, CASE state WHEN 2 THEN 'assistant:' ELSE 'user:' END) FROM nodes) AS m
            JOIN f ON f.conv_id IS NOT DISTINCT FROM m.conv_id AND f.n = m.n + 1,
            LATERAL (SELECT unnest([{'edit': 'D', 'price': 3, 'state': m.state},
                {'edit': 'R', 'price': 2, 'state': CASE m.state WHEN 2 THEN 3 ELSE 2 END},
                {'edit': 'K', 'price': 0, 'state': CASE WHEN initial = 's' THEN 1 WHEN m.state = 2 THEN 3 ELSE 2 END}],
                recursive := true)) AS e
            WHERE e.edit = 'D' OR fault < 2 AND (e.edit = 'R' OR initial = CASE m.state WHEN 2 THEN 'a' ELSE 'u' END
                OR initial = 's' AND m.state = 0))
        GROUP BY conv_id, n, state),
    totals AS (SELECT conv_id, max(n) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 2) AS blank, count(*) FILTER (fault = 3) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
        count(*) FILTER (neighbours NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
    ends AS (SELECT t.conv_id, min(CASE state WHEN 0 THEN best WHEN 3 THEN best
            WHEN 2 THEN {'cost': best.cost + 2, 'audit': best.audit || 'I', 'turns': list_append(best.turns, 'assistant:')}
            ELSE {'cost': best.cost + 4, 'audit': best.audit || 'II', 'turns': best.turns || ['user:', 'assistant:']} END) AS best
        FROM totals t JOIN nodes ON nodes.conv_id IS NOT DISTINCT FROM t.conv_id AND nodes.n = t.n GROUP BY t.conv_id)
    SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
        coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
        coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.turns, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) AS c
    LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""


@query("op13_conversation_repair", REPAIR_SQL)
def op13_conversation_repair(spark, sf_dir):
    return repair_report(damaged(table(spark, sf_dir, "conversations")))
