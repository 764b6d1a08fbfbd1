"""One query per operator: whole tables in, one digest row per document, line, page, piece or conversation out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roundhouse.llm import bpe, chat, divergence, exact_dedup, lexical_search, line_dedup, near_dedup, packing, quality_model, quality_rules, secret_scan, toxicity, url_filter
from roundhouse.llm.common import labelled, table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, labelled(spark, sf_dir, "toxic")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, line_no, n_words, keep_doc, keep_line, kept of each line with words."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id (least doc_id of the class) and kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.classes(docs).withColumn("kept", F.col("doc_id") == F.col("class_id"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_model.scored(*quality_model.fit_documents(docs, labelled(spark, sf_dir, "quality")))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the base statistics, quality_p, base_failed and kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality_p"]
    return quality_rules.judge(docs, keep=["doc_id"]).select("doc_id", *[f"__quality.{x}" for x in columns])


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256."""
    return exact_dedup.assign(table(spark, sf_dir, "documents").select("doc_id", "text"), largest=True)


def page_captures(pages: DataFrame) -> DataFrame:
    """page_id, url and a fetch day within 2024 that follows from the page_id."""
    return pages.selectExpr("page_id", "url", "date_add(date'2024-01-01', cast((page_id * 37) % 365 as int)) as fetch_day")


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries of three lists, drawn from the hosts of all pages by a hash of the host."""
    hosts = pages.select(url_filter.host_of(F.col("url")).alias("host")).where("host <> ''").distinct().withColumn("k", F.conv(F.substring(F.md5("host"), 1, 6), 16, 10).cast("int"))
    parts = [
        ("ads", "host", "k % 180", "add", "k % 4 = 0"),
        ("ads", "host", "k % 180 + 30 + k % 90", "remove", "k % 4 = 0 and k % 3 > 0"),
        ("ads", "host", "k % 180 + 150", "add", "k % 12 = 4"),
        ("malware", "concat(host, '/en')", "k % 300", "add", "k % 5 = 1"),
        ("policy", "substr(host, instr(host, '.') + 1)", "k % 330", "add", "k % 7 = 2"),
        ("policy", "substr(host, instr(host, '.') + 1)", "k % 330 + 20", "remove", "k % 14 = 2"),
    ]
    frames = [hosts.where(when).selectExpr(f"'{name}' as list", f"{pattern} as pattern", f"date_add(date'2024-01-01', {day}) as day", f"'{action}' as action") for name, pattern, day, action, when in parts]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, fetch_day, host, blocked, list, pattern of each page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filtered(page_captures(pages), list_entries(pages))


def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = tokenizer_path()
    out = bpe.decode(bpe.encode(docs, path, keep=["doc_id"]), path)
    return out.select("doc_id", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"), F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of each piece."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the formatted conversations."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    extra = rows.sparkSession.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(rows.unionByName(extra), tokenizer_path()))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents"), keep=["doc_id"]))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, rank, doc_id, score of the 20 best documents of each benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang, source, part, item, value, rank."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_toxicity_grammar, op2_line_dedup, op3_minhash_near_dedup, op4_quality_classifier, op5_quality_rules, op6_exact_dedup, op7_url_filters, op8_bpe_codec, op9_packing, op10_chat_format)
    + (op11_secret_scan, op12_lexical_search, op13_source_divergence)
}

def _scan_sql() -> str:
    """The secret scan in SQL: places are running sums over the lengths of matches and of the pieces between them, links are joins of intervals."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    kinds = secret_scan.KINDS
    rules = [("" if i else "VALUES ") + f"({i}, '{k.name}', '{k.role}', {k.weight}, {k.strong})" for i, k in enumerate(kinds)]
    split = lambda i, pattern, group, least: f"SELECT r, {i} AS k, unnest(regexp_extract_all(t, {quoted(pattern)})) AS m, unnest(range(len(regexp_extract_all(t, {quoted(pattern)})))) AS i, regexp_split_to_array(t, {quoted(pattern)}) AS y, {quoted(pattern)} AS p, {group} AS g, {least} AS least FROM d"
    long_enough = " UNION ALL ".join(f"SELECT * FROM placed WHERE k = {i} AND len(regexp_extract(m, {quoted(k.pattern)}, {k.group})) >= {k.least}" for i, k in enumerate(kinds))
    parts = " UNION ALL ".join([split(i, k.pattern, k.group, k.least) for i, k in enumerate(kinds)] + [split(-1, secret_scan.BLANK_LINE, 0, 1)])
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
        rules(k, kind, role, weight, strong) AS ({", ".join(rules)}),
        parts AS ({parts}),
        placed AS (SELECT r, k, m, sum(len(y[i + 1])) OVER upto + sum(len(m)) OVER upto - len(m) AS a, sum(len(y[i + 1])) OVER upto + sum(len(m)) OVER upto AS b
                   FROM parts WINDOW upto AS (PARTITION BY r, k ORDER BY i)),
        blanks AS (SELECT r, a, b FROM placed WHERE k = -1),
        found AS (SELECT r, a, b, rules.* FROM ({long_enough}) JOIN rules USING (k)),
        strong AS (SELECT * FROM found WHERE strong),
        weak AS (SELECT * FROM found f WHERE NOT strong AND NOT EXISTS (SELECT 1 FROM strong s WHERE s.r = f.r AND s.role = f.role AND s.a < f.b AND s.b > f.a)),
        wide AS (SELECT w.r, w.a, w.b, w.k, w.role, w.weight, greatest(w.a - {secret_scan.REACH}, coalesce(max(x.b) FILTER (x.a <= w.a), 0)) AS lo,
                        least(w.b + {secret_scan.REACH}, coalesce(min(x.a) FILTER (x.a > w.a), 9223372036854775807)) AS hi
                 FROM weak w LEFT JOIN blanks x ON x.r = w.r GROUP BY w.r, w.a, w.b, w.k, w.role, w.weight),
        near AS (SELECT w.r, w.a, w.b, w.k, w.role, w.weight, p.role AS other, max(p.weight) AS best FROM wide w
                 JOIN (SELECT r, a, b, role, weight FROM strong UNION ALL SELECT r, a, b, role, weight FROM weak) p ON p.r = w.r AND p.role <> w.role AND p.a < w.hi AND p.b > w.lo GROUP BY ALL),
        joined AS (SELECT r, a, b, k FROM near GROUP BY r, a, b, k, role, weight
                   HAVING weight + sum(best) >= {secret_scan.LEAST} AND (role = 'secret' OR bool_or(other = 'secret'))),
        spans AS (SELECT r, a, b, k FROM strong UNION ALL SELECT * FROM joined),
        told AS (SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
                        string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k) FILTER (k <= 2) AS base, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k) AS spans
                 FROM spans JOIN rules USING (k) GROUP BY r)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN told USING (r)"""


ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": r"""
        WITH raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents),
        l AS (SELECT doc_id, line_no::INTEGER AS line_no, list_filter(regexp_split_to_array(line, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words FROM raw),
        lines AS (SELECT doc_id, line_no, words, len(words)::INTEGER AS n_words, array_to_string(words, ' ') AS line FROM l WHERE len(words) > 0),
        firsts AS (SELECT line, any_value(words) AS words, any_value(n_words) AS n, min({'d': doc_id, 'l': line_no}) AS ord FROM lines GROUP BY line),
        v AS (SELECT line, ord, i AS pos, md5(array_to_string(list_concat(words[1:i], words[i + 2:]), ' ')) AS key FROM firsts, unnest(range(n)) t(i) WHERE n >= 5
              UNION ALL SELECT line, ord, -1, md5(line) FROM firsts WHERE n >= 5),
        near AS (SELECT a.line, min(b.ord) AS ord FROM v a JOIN v b ON a.key = b.key AND (a.pos = b.pos OR a.pos = -1 OR b.pos = -1) AND b.ord < a.ord GROUP BY a.line),
        best AS (SELECT f.line, least(f.ord, coalesce(n.ord, f.ord)) AS k FROM firsts f LEFT JOIN near n ON f.line = n.line)
        SELECT doc_id, line_no, n_words, k.d AS keep_doc, k.l AS keep_line, doc_id = k.d AND line_no = k.l AS kept FROM lines JOIN best USING (line)""",
    "op6_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY body) AS kept, sha256(body) AS text_sha256
        FROM d""",
    "op7_url_filters": r"""
        WITH p AS (SELECT page_id, DATE '2024-01-01' + ((page_id * 37) % 365)::INTEGER AS fetch_day,
                          lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)) AS host,
                          regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path FROM pages),
        h AS (SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 6))::INTEGER AS k FROM p WHERE host <> ''),
        e AS (SELECT 'ads' AS list, host AS pattern, k % 180 AS day, 'add' AS action FROM h WHERE k % 4 = 0
              UNION ALL SELECT 'ads', host, k % 180 + 30 + k % 90, 'remove' FROM h WHERE k % 4 = 0 AND k % 3 > 0
              UNION ALL SELECT 'ads', host, k % 180 + 150, 'add' FROM h WHERE k % 12 = 4
              UNION ALL SELECT 'malware', host || '/en', k % 300, 'add' FROM h WHERE k % 5 = 1
              UNION ALL SELECT 'policy', substr(host, instr(host, '.') + 1), k % 330, 'add' FROM h WHERE k % 7 = 2
              UNION ALL SELECT 'policy', substr(host, instr(host, '.') + 1), k % 330 + 20, 'remove' FROM h WHERE k % 14 = 2),
        daily AS (SELECT list, pattern, DATE '2024-01-01' + day AS day, max(action) AS action FROM e GROUP BY ALL),
        iv AS (SELECT *, lead(day) OVER (PARTITION BY list, pattern ORDER BY day) AS until FROM daily),
        act AS (SELECT list, pattern, day, until, string_split(pattern, '/')[1] AS dom, substr(pattern, len(string_split(pattern, '/')[1]) + 1) AS sub FROM iv WHERE action = 'add'),
        m AS (SELECT page_id, list, pattern, row_number() OVER (PARTITION BY page_id ORDER BY len(pattern) DESC, list, pattern) AS rn
              FROM p JOIN act ON (host = dom OR ends_with(host, '.' || dom)) AND (sub = '' OR path = sub OR starts_with(path, sub || '/'))
                             AND day <= fetch_day AND (until IS NULL OR fetch_day < until))
        SELECT p.page_id, fetch_day, host, m.pattern IS NOT NULL AS blocked, m.list, m.pattern FROM p LEFT JOIN m ON p.page_id = m.page_id AND rn = 1""",
    "op11_secret_scan": _scan_sql(),
    "op12_lexical_search": r"""
        WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM lowered),
        q AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        qt AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY ALL),
        tf AS (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
        tfs AS (SELECT r, doc_id, n, term, count(*) AS tf FROM tf GROUP BY ALL),
        c AS (SELECT count(*) AS nd, sum(len(terms))::BIGINT AS l FROM d WHERE len(terms) > 0),
        w AS (SELECT term, floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, c GROUP BY term, nd),
        s AS (SELECT item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // l))))::BIGINT AS score
              FROM qt JOIN tfs USING (term) JOIN w USING (term), c GROUP BY ALL),
        o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 20""",
    "op13_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        t AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 10),
        counts AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        v AS (SELECT lang, count(*) AS v, sum(total)::BIGINT AS lang_n FROM kept GROUP BY lang),
        g AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::BIGINT AS n FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN counts c USING (lang, source) GROUP BY ALL),
        p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS cnt, 1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (g.n + 2 * v) AS p, 1 + (1000000000 * (total + 2)) // (lang_n + 2 * v) AS q
              FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p))::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        bare AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                 LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
        own AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p WHERE cnt > 0 AND p > q),
        parts AS (SELECT lang, source, 'pair' AS part, item, value FROM bare UNION ALL SELECT lang, source, 'term', item, value FROM own),
        o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts)
        SELECT * FROM o WHERE part = 'pair' OR rank <= 10""",
}
