"""One query per operator over the shared tables, with production parameters, and the SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

WORD_TOKENIZER = {"blank": "dropped", "lower": True}
BYTE_TOKENIZER = {"blank": "leading", "lower": False}
END_ID = 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    from millrace.llm.tokens import read_tokens, tokens_folder, write_tokens

    place = tokens_folder(spark)
    shards = write_tokens(
        table(spark, folder, "documents"), place, tokenizer_path("word_bpe_49k.json"), end_id=END_ID, kind="<u2", **WORD_TOKENIZER
    )
    return read_tokens(shards, place, kind="<u2", with_ids=False)


@query
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    from millrace.llm.packing import pack_tokens

    return pack_tokens(
        table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=END_ID, **BYTE_TOKENIZER
    )


#: A sequence of instruction data: tokens, segments, and tokens that bear loss.
EXAMPLE_LIMITS = (2048, 8, 1024)


@query
def op5_packing_examples(spark: SparkSession, folder: str) -> DataFrame:
    """Answers of `conversations` with the turn before each as its prompt, which bears no loss, under three limits at once."""
    from millrace.llm.packing import Limits, pack_tokens

    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.concat("text", F.lit("\n")).alias("prompt"))
    answers = turns.where("role = 'assistant'").join(before, ["conv_id", "turn"], "left")
    prompt = F.coalesce("prompt", F.lit(""))
    examples = answers.select(
        (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("doc_id"), F.concat(prompt, "text").alias("text"), F.length(prompt).alias("prompt_chars")
    )
    return pack_tokens(
        examples, tokenizer_path("byte_bpe_50k.json"), end_id=END_ID, limits=Limits(*EXAMPLE_LIMITS), prompt_chars_column="prompt_chars", **BYTE_TOKENIZER
    )


def outside_fold(df: DataFrame, parts: int, part: int) -> DataFrame:
    """Rows whose id does not fall into the held-out fold."""
    return df.where(F.crc32(F.col("doc_id").cast("string")) % parts != part)


def with_fold(scored: DataFrame, parts: int, part: int, threshold: float) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == part, F.lit(False))
    return scored.withColumns({"held_out": held_out, "predicted": (F.col("score") >= threshold).cast("int")})


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from millrace.llm import toxicity

    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, outside_fold(table(spark, folder, "labels"), 4, 2))
    scored = with_fold(toxicity.score(docs, model), 4, 2, 0.3)
    return scored.select("doc_id", "held_out", "score", "predicted", F.to_json("spans").alias("spans"))


@query
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    from millrace.llm import classifier

    docs = table(spark, folder, "documents")
    forest = classifier.train(docs, outside_fold(table(spark, folder, "labels"), 3, 1))
    return with_fold(classifier.score(docs, forest), 3, 1, 0.5)


@query
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from millrace.llm import rules

    docs = table(spark, folder, "documents")
    trusted = table(spark, folder, "labels").where("quality = 1").select("doc_id").hint("merge")  # grows with the documents
    return rules.judge(docs, trusted)


@query
def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    from millrace.llm import licenses

    return licenses.scan(table(spark, folder, "documents"))


@query
def op10_license_passages(spark: SparkSession, folder: str) -> DataFrame:
    from millrace.llm import licenses

    return licenses.passages(table(spark, folder, "documents"))


def licenses_sql() -> str:
    from millrace.llm.licenses import TEMPLATES, THRESHOLD

    templates = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in TEMPLATES.items())
    words = r"list_filter(regexp_split_to_array(lower({}), '[^a-z0-9\x{{80}}-\x{{10ffff}}]+'), lambda w: w <> '')".format
    grams = (
        "CASE WHEN len(w) > 1 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) "
        "ELSE list_distinct(w) END"
    )
    return f"""
    WITH template AS (
        SELECT license, {grams} AS g FROM (SELECT license, {words("body")} AS w FROM (VALUES {templates}) t(license, body))
    ), split AS (
        SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts, coalesce(text, '') AS body FROM documents
    ), unit AS (
        SELECT doc_id, 'line' AS unit, (i - 1)::INTEGER AS line_no, parts[i] AS t
        FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM split)
        UNION ALL
        SELECT doc_id, 'document', NULL, body FROM split WHERE len(parts) > 1
    ), counted AS (
        SELECT doc_id, unit, line_no, {grams} AS u FROM (SELECT doc_id, unit, line_no, {words("t")} AS w FROM unit)
    ), pairs AS (
        SELECT doc_id, unit, line_no, license, len(list_intersect(u, g))::INTEGER AS common, len(u)::INTEGER AS n_unit,
            len(g)::INTEGER AS n_template
        FROM counted, template WHERE len(u) > 0
    )
    SELECT *, 2.0::DOUBLE * common / (n_unit + n_template) AS dice FROM pairs
    WHERE 2.0::DOUBLE * common >= {THRESHOLD}::DOUBLE * (n_unit + n_template)
    """


SQL["op10_licenses"] = licenses_sql()


#: Weights of the languages in the mixture.
LANGUAGES = {"en": 0.6, "de": 0.15, "fr": 0.15, "es": 0.1}


@query
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    from millrace.llm import mixing

    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    labelled = docs.drop("text").join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")
    model = mixing.train(docs, labelled, "lang", list(LANGUAGES))
    mixed = mixing.mix(docs.drop("lang"), model, LANGUAGES, keep_text=False)
    shares = [F.get("__p", F.lit(k)).alias(f"p_{name}") for k, name in enumerate(model.names)]
    return mixed.select("doc_id", F.col("__tokens").alias("n_tokens"), *shares, F.col("__rate").alias("rate"), F.col("__copies").alias("copies"))


@query
def op8_vectors(spark: SparkSession, folder: str) -> DataFrame:
    from millrace.llm import vectors

    return vectors.near_duplicates(table(spark, folder, "embeddings"))


SQL["op8_vectors"] = """
    WITH RECURSIVE usable AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links AS (
        SELECT a.vec_id AS u, b.vec_id AS w
        FROM usable a JOIN usable b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
        WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.98
    ), reach AS (
        SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, links.w FROM reach JOIN links ON links.u = reach.r
    ), counts AS (SELECT u, count(*) AS n FROM links GROUP BY u),
    least AS (SELECT vec_id, min(r) AS c FROM reach GROUP BY vec_id)
    SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, coalesce(e.vec_id = c, true) AS kept
    FROM embeddings e LEFT JOIN counts ON counts.u = e.vec_id LEFT JOIN least ON least.vec_id = e.vec_id
"""


@query
def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    from millrace.llm import near

    return near.near_duplicates(table(spark, folder, "documents"))


@query
def op2_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    from millrace.llm import suffixes

    found = suffixes.repeated_spans(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op13_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    from millrace.llm import bestfit

    return bestfit.pack(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0, **BYTE_TOKENIZER)


@query
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    from millrace.llm import lexical

    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def search_sql() -> str:
    words = (
        "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[0-9A-Za-z\x{80}-\x{10FFFF}]+')"
    )
    return f"""
    WITH doc AS (
        SELECT doc_id, n, t FROM (SELECT doc_id, {words} AS t, len(t)::BIGINT AS n FROM documents) WHERE n > 0
    ), size AS (
        SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM doc
    ), item AS (
        SELECT item_id, text, term, count(*)::BIGINT AS times
        FROM (SELECT item_id, text, unnest({words}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL
    ), held AS (
        SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM doc)
        WHERE term IN (SELECT term FROM item) GROUP BY ALL
    ), weight AS (
        SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, size GROUP BY term, docs
    ), scored AS (
        SELECT item_id, text, doc_id,
            sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total))))::BIGINT AS score
        FROM item JOIN held USING (term) JOIN weight USING (term), size GROUP BY item_id, text, doc_id
    ), ranked AS (
        SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id)::INTEGER AS rank
        FROM scored WHERE score > 0
    )
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """


SQL["op12_ranked_search"] = search_sql()


@query
def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    from millrace.llm import trie

    return trie.prefix_trie(trie.spliced(trie.turn_paths(table(spark, folder, "conversations"))))


#: Each member adds what it alone has below a node, so sums over subtrees are plain sums over members.
SQL["op11_conversation_trie"] = """
    WITH own AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS d
        FROM conversations WHERE conv_id IS NOT NULL
    ), conv AS (
        SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
            lambda s, b: list_reduce(
                list_prepend(xor(s, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                lambda t, z: CASE WHEN t & 1 = 1 THEN xor(t >> 1, 3988292384) ELSE t >> 1 END
            )
        ), 4294967295) % 6 AS h
        FROM (SELECT DISTINCT conv_id FROM own)
    ), rebuilt AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, d) AS depth, role, text FROM (
            SELECT c.conv_id, 0 AS part, o.d, o.role, o.text FROM conv c JOIN own o ON o.conv_id = c.base AND o.d <= c.h
            UNION ALL
            SELECT c.conv_id, 1, o.d, o.role, o.text FROM conv c JOIN own o ON o.conv_id = c.conv_id AND o.d > c.h
        )
    ), member AS (
        SELECT conv_id, depth, string_agg(md5(length(role) || ':' || role || text), '') OVER w AS node,
            length(text) AS size, sum(length(text)) OVER w AS up_to
        FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
        UNION ALL
        SELECT conv_id, 0, '', 0, 0 FROM conv
    ), whole AS (
        SELECT conv_id, max(depth) AS last, max(up_to) AS total FROM member GROUP BY conv_id
    ), first AS (
        SELECT node, min(conv_id) AS conv FROM member GROUP BY node
    ), owned AS (
        SELECT m.conv_id, min(m.depth) AS since FROM member m JOIN first f ON f.node = m.node AND f.conv = m.conv_id GROUP BY m.conv_id
    ), leaf AS (
        SELECT w.conv_id, w.last FROM whole w JOIN member m ON m.conv_id = w.conv_id AND m.depth = w.last
        JOIN first f ON f.node = m.node AND f.conv = w.conv_id
        WHERE NOT EXISTS (
            SELECT 1 FROM member x JOIN member y ON y.conv_id = x.conv_id AND y.depth = x.depth + 1 WHERE x.node = m.node
        )
    ), added AS (
        SELECT m.node, m.depth, m.conv_id, m.size, w.last,
            w.total - m.up_to + m.size AS walked,
            CASE WHEN o.since IS NULL OR w.last < greatest(o.since, m.depth) THEN 0
                ELSE w.total - p.up_to + p.size END AS alone,
            CASE WHEN o.since <= m.depth + 1 AND w.last > m.depth THEN 1 ELSE 0 END AS child,
            CASE WHEN l.conv_id IS NULL THEN 0 ELSE 1 END AS leaf
        FROM member m JOIN whole w USING (conv_id) LEFT JOIN owned o USING (conv_id) LEFT JOIN leaf l USING (conv_id)
        LEFT JOIN member p ON p.conv_id = m.conv_id AND p.depth = greatest(o.since, m.depth)
    ), nodes AS (
        SELECT node, min(depth)::BIGINT AS depth, min(conv_id) AS conv_id, count(*)::BIGINT AS n_convs, sum(child)::BIGINT AS n_children,
            sum(leaf)::BIGINT AS n_leaves, (sum(walked) - sum(alone))::BIGINT AS saved_tokens,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last = depth), '')) AS ends_sha256
        FROM added GROUP BY node
    )
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n.n_leaves, n.saved_tokens, n.ends_sha256
    FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.node = left(n.node, (32 * (n.depth - 1))::INTEGER)
"""
