"""Vector and metadata search, embeddings, text preparation, session preferences."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ludolytics.functions import text as T
from ludolytics.functions.vectors import cosine_distance, has_size
from ludolytics.operators.blocks import unpack
from ludolytics.plans import retrieval, session_search
from ludolytics.session import scratch_path
from ludolytics.workloads import bindings as b
from ludolytics.workloads.oracle import layered
from ludolytics.workloads.registry import workload

_CENTRES = """
flat AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
dims AS (SELECT label, i, round(avg(x), 6) AS x FROM flat GROUP BY label, i),
centres AS (SELECT label AS query_id, list(x ORDER BY i) AS v FROM dims GROUP BY label)"""

_NEAREST = f"""
WITH {_CENTRES.strip()},
sims AS (SELECT c.query_id, e.vec_id AS game_id, list_cosine_similarity(e.embedding::DOUBLE[], c.v) AS similarity
         FROM centres c, embeddings e),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, game_id) AS rank FROM sims)
SELECT query_id, game_id, round(similarity, 9) AS similarity, rank FROM ranked WHERE rank <= 10"""


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 9) for c in columns})


@workload("semantic_search_batch", "V01 K05", _NEAREST)
def _(spark, d):
    hits = retrieval.semantic_search_batch(b.profiles(spark, d), b.label_centres(spark, d))
    return _rounded(hits, "similarity")


@workload(
    "semantic_search_one",
    "V01 J16 F23 K05",
    layered(
        """
SELECT h.game_id, game_name, round(similarity, 9) AS similarity
FROM (SELECT vec_id AS game_id,
             list_cosine_similarity(embedding::DOUBLE[], [(i % 7) - 3.0 for i in range(64)]) AS similarity
      FROM embeddings ORDER BY similarity DESC, game_id LIMIT 10) h
JOIN dim_games g ON g.game_id = h.game_id"""
    ),
)
def _(spark, d):
    query = [float(i % 7 - 3) for i in range(64)]
    games = b.stored_models(spark, d)["dim_games"]
    return _rounded(retrieval.semantic_search(b.profiles(spark, d), query, 10, games), "similarity")


@workload("list_index_all_probes", "V02", _NEAREST)
def _(spark, d):
    profiles = b.profiles(spark, d)
    index = retrieval.ListIndex(lists=16, seed=7).fit(profiles)
    hits = index.search(index.assign(profiles), b.label_centres(spark, d), nprobe=16)
    return _rounded(hits, "similarity")


@workload(
    "list_index_few_probes",
    "V02",
    f"""
WITH {_CENTRES.strip()}
SELECT query_id, 10 AS hits, 10 AS right_similarities FROM centres""",
)
def _(spark, d):
    # which profiles are met depends on the clustering, but each hit's similarity must be exact
    profiles, asked = b.profiles(spark, d), b.label_centres(spark, d)
    index = retrieval.ListIndex(lists=16, seed=7).fit(profiles)
    hits = index.search(index.assign(profiles), asked, nprobe=4)
    centres = asked.withColumnRenamed("embedding", "centre")
    again = hits.join(profiles, "game_id").join(centres, "query_id")
    right = F.abs(1 - cosine_distance(F.col("embedding"), F.col("centre")) - F.col("similarity")) < 1e-9
    return again.groupBy("query_id").agg(
        F.count("*").cast("int").alias("hits"),
        F.sum(right.cast("int")).cast("int").alias("right_similarities"),
    )


_TWENTIETH = """
sims AS (SELECT q.vec_id AS query_id, e.vec_id AS game_id,
                list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS similarity
         FROM embeddings q, embeddings e WHERE q.vec_id % 20 = 0)"""


def _asked(spark, d):
    """Every row whose id is divisible by 20, as a query against all rows."""
    profiles = b.profiles(spark, d)
    return profiles, profiles.where("game_id % 20 = 0").withColumnRenamed("game_id", "query_id")


def _stored_index(spark, profiles):
    return retrieval.ListIndex(lists=16, seed=7).fit(profiles).store(profiles, scratch_path(spark, "list-index"))


@workload(
    "stored_index_all_probes",
    "V02 K05",
    f"""
WITH {_TWENTIETH.strip()}
SELECT query_id, rank, round(similarity, 9) AS similarity
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, game_id) AS rank FROM sims) WHERE rank <= 10""",
)
def _(spark, d):
    profiles, asked = _asked(spark, d)
    hits = _stored_index(spark, profiles).search(asked, nprobe=16)
    return _rounded(hits.select("query_id", "rank", "similarity"), "similarity")


@workload("stored_index_hits", "V02 K05")
def _(spark, d):
    # which neighbours are met depends on the clustering; stored_index_recall measures them
    profiles, asked = _asked(spark, d)
    return _rounded(_stored_index(spark, profiles).search(asked, nprobe=12), "similarity")


@workload(
    "stored_index_recall",
    "V02",
    """
SELECT count(*) AS queries, sum(least(10, (SELECT count(*) FROM embeddings)))::BIGINT AS wanted, true AS enough
FROM embeddings WHERE vec_id % 20 = 0""",
)
def _(spark, d):
    """Of the exact ten nearest of each query, the share that 12 of 16 lists give is 0.9 or more."""
    profiles, asked = _asked(spark, d)
    exact = retrieval.semantic_search_batch(profiles, asked).select("query_id", "game_id")
    hits = _stored_index(spark, profiles).search(asked, nprobe=12).select("query_id", "game_id", F.lit(1).alias("hit"))
    both = exact.join(hits, ["query_id", "game_id"], "left")
    return both.agg(
        F.count_distinct("query_id").alias("queries"), F.count("*").alias("wanted"),
        (F.sum(F.coalesce("hit", F.lit(0))) >= 0.9 * F.count("*")).alias("enough"),
    )


@workload(
    "cosine_to_own_label",
    "F23",
    f"""
WITH {_CENTRES.strip()}
SELECT vec_id, label, len(embedding) = 64 AS right_size,
       round(1 - list_cosine_similarity(embedding::DOUBLE[], v), 9) AS distance
FROM embeddings JOIN centres ON query_id = label""",
)
def _(spark, d):
    vectors = b.table(spark, d, "embeddings")
    centres = b.label_centres(spark, d).withColumnRenamed("embedding", "centre")
    joined = vectors.join(centres, F.col("label") == F.col("query_id"))
    distance = cosine_distance(F.col("embedding"), F.col("centre"))
    return _rounded(
        joined.select("vec_id", "label", has_size("embedding", 64).alias("right_size"), distance.alias("distance")),
        "distance",
    )


@workload(
    "similarity_matrix",
    "T08",
    f"""
WITH {_CENTRES.strip()}
SELECT e.vec_id AS id, c.query_id AS other_id, round(list_cosine_similarity(e.embedding::DOUBLE[], c.v), 9) AS similarity
FROM embeddings e, centres c""",
)
def _(spark, d):
    vectors = b.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    centres = b.label_centres(spark, d).withColumnRenamed("query_id", "id")
    # the larger side goes right: only the left one is copied to every shard
    strips = retrieval.similarity_matrix(centres, vectors, "id", "embedding")
    cells = strips.select(
        F.col("id").alias("other_id"), F.inline(F.arrays_zip("other_ids", "similarities")).alias("id", "similarity")
    )
    return _rounded(cells, "similarity")


@workload(
    "chunk_set_similarity",
    "T09",
    """
WITH pairs AS (SELECT a.label AS left_game, b.label AS right_game
               FROM (SELECT DISTINCT label FROM embeddings) a, (SELECT DISTINCT label FROM embeddings) b
               WHERE b.label = a.label + 1),
best AS (SELECT left_game, right_game, l.vec_id,
                max(list_cosine_similarity(l.embedding::DOUBLE[], r.embedding::DOUBLE[])) AS s
         FROM pairs JOIN embeddings l ON l.label = left_game JOIN embeddings r ON r.label = right_game
         GROUP BY 1, 2, 3)
SELECT left_game, right_game, round(avg(s), 9) AS mean_max_similarity FROM best GROUP BY 1, 2""",
)
def _(spark, d):
    chunks = b.table(spark, d, "embeddings").select("label", "vec_id", "embedding")
    labels = chunks.select("label").distinct()
    following = labels.select((F.col("label") - 1).alias("left_game"), F.col("label").alias("right_game"))
    pairs = following.join(labels.select(F.col("label").alias("left_game")), "left_game", "left_semi")
    out = retrieval.chunk_set_similarity(chunks, pairs, "label", "vec_id", "embedding")
    return _rounded(out, "mean_max_similarity")


@workload(
    "vectors_by_group",
    "G18",
    """
SELECT label, vec_id, CAST(unnest(range(1, 65)) AS INTEGER) AS place, unnest(embedding)::DOUBLE AS component
FROM embeddings""",
)
def _(spark, d):
    stored = retrieval.vectors_by_group(b.table(spark, d, "embeddings"), "label", ["vec_id"], "embedding")
    rows = unpack(stored).select("label", "vec_id", F.posexplode("embedding").alias("place", "component"))
    return rows.withColumn("place", F.col("place") + 1)


_SEARCHES = {
    "genre": ({"genres": ["STANDARD", "Brand#7"]}, "list_has_any(game_genres, ['STANDARD', 'Brand#7'])"),
    "category": ({"categories": ["widget"]}, "list_has_any(game_categories, ['widget'])"),
    "developer": ({"developers": ["BRAND#2"]}, "lower(array_to_string(game_developers, '|')) LIKE '%brand#2%'"),
    "publisher": (
        {"publishers": ["econ", "large"], "release_date_after": "1995-01-01", "review_score_min": 20},
        "(lower(array_to_string(game_publishers, '|')) LIKE '%econ%'"
        " OR lower(array_to_string(game_publishers, '|')) LIKE '%large%')"
        " AND game_prerelease_date >= TIMESTAMP '1995-01-01' AND game_review_score >= 20",
    ),
    "described": (
        {"review_score_description": "Mixed", "release_date_before": date(1995, 12, 31), "review_score_min": 0},
        "game_review_score_description = 'Mixed' AND game_prerelease_date <= TIMESTAMP '1995-12-31'",
    ),
    "anything": ({"limit": 500}, "true"),
}


@workload(
    "metadata_search",
    "V03 V03a V03b V03c V03d F17 F21 F22 K05",
    layered(
        "\nUNION ALL\n".join(
            f"""(SELECT '{name}' AS search, game_id, game_name, game_review_score FROM dim_games
  WHERE {condition} AND game_review_score IS NOT NULL AND game_review_score_description IS NOT NULL
  ORDER BY game_review_score DESC, game_id LIMIT {kwargs.get('limit', 100)})"""
            for name, (kwargs, condition) in _SEARCHES.items()
        )
    ),
)
def _(spark, d):
    games = b.stored_models(spark, d)["dim_games"]
    out = None
    for name, (kwargs, _) in _SEARCHES.items():
        part = retrieval.metadata_search(games, **kwargs).select(
            F.lit(name).alias("search"), "game_id", "game_name", "game_review_score"
        )
        out = part if out is None else out.unionByName(part)
    return out


_TURNS = """
turns AS (
  SELECT conv_id AS session_id, turn,
         CASE role WHEN 'user' THEN 'developers' WHEN 'assistant' THEN 'publishers' ELSE 'genres' END AS key,
         text AS value FROM conversations
  UNION ALL
  SELECT conv_id, turn, 'status', CASE WHEN role = 'assistant' THEN 'READY' ELSE 'GATHERING' END FROM conversations),
latest AS (SELECT * FROM turns QUALIFY row_number() OVER (PARTITION BY session_id, key ORDER BY turn DESC) = 1),
folded AS (SELECT session_id, max(value) FILTER (WHERE key = 'developers') AS developers,
                  max(value) FILTER (WHERE key = 'publishers') AS publishers,
                  max(value) FILTER (WHERE key = 'genres') AS genres,
                  max(value) FILTER (WHERE key = 'status') AS status
           FROM latest GROUP BY session_id)"""


def _folded(spark, d):
    conversations = b.table(spark, d, "conversations")
    role_key = (
        F.when(F.col("role") == "user", "developers").when(F.col("role") == "assistant", "publishers").otherwise("genres")
    )
    said = conversations.select(
        F.col("conv_id").alias("session_id"), "turn", role_key.alias("key"), F.col("text").alias("value")
    )
    status = conversations.select(
        F.col("conv_id").alias("session_id"),
        "turn",
        F.lit("status").alias("key"),
        F.when(F.col("role") == "assistant", "READY").otherwise("GATHERING").alias("value"),
    )
    return retrieval.fold_preferences(said.unionByName(status))


def _flat(folded):
    return folded.select(
        "session_id", *[F.col("preferences")[k].alias(k) for k in ("developers", "publishers", "genres")], "status"
    )


@workload("fold_preferences", "V04", f"WITH {_TURNS.strip()} SELECT * FROM folded")
def _(spark, d):
    return _flat(_folded(spark, d))


@workload("ready_sessions", "V04", f"WITH {_TURNS.strip()} SELECT * FROM folded WHERE status = 'READY'")
def _(spark, d):
    return _flat(retrieval.ready_sessions(_folded(spark, d)))


_ASKED = """
asked AS (
  SELECT o_custkey AS session_id, o_orderkey AS turn, o_orderkey % 9 AS kind, o_orderkey // 9 AS k FROM orders),
turns AS (
  SELECT session_id, turn, CASE kind WHEN 0 THEN 'genres' WHEN 1 THEN 'categories' WHEN 2 THEN 'developers' WHEN 3 THEN 'publishers'
             WHEN 4 THEN 'release_date_after' WHEN 5 THEN 'release_date_before' WHEN 6 THEN 'review_score_min'
             WHEN 7 THEN 'review_score_description' END AS key,
         CASE kind WHEN 0 THEN '["' || ['STANDARD', 'LARGE', 'PROMO', 'Brand#7', 'None'][k % 5 + 1] || '","Brand#' || k % 25 || '"]'
             WHEN 1 THEN ['widget', '["rod","old"]', '[]', 'ring'][k % 4 + 1]
             WHEN 2 THEN ['BRAND#2', '["#1","ND#9"]', 'x'][k % 3 + 1] WHEN 3 THEN ['econ', 'a', '["promo"]'][k % 3 + 1]
             WHEN 4 THEN '199' || 4 + k % 3 || '-03-01' WHEN 5 THEN ['1996-01-01', 'soon'][k % 2 + 1]
             WHEN 6 THEN (k % 4 * 10)::VARCHAR WHEN 7 THEN ['Mixed', '', 'Mostly Positive'][k % 3 + 1] END AS value
  FROM asked WHERE kind < 8
  UNION ALL SELECT session_id, turn, 'status', CASE WHEN turn % 5 > 0 THEN 'READY' ELSE 'GATHERING' END FROM asked),
said AS (
  SELECT session_id, key, value FROM turns QUALIFY row_number() OVER (PARTITION BY session_id, key ORDER BY turn DESC) = 1),
ready AS (SELECT session_id FROM said WHERE key = 'status' AND value = 'READY'),
wanted AS (
  SELECT session_id, max(value) FILTER (key = 'genres') AS genres, max(value) FILTER (key = 'categories') AS categories,
         max(value) FILTER (key = 'developers') AS developers, max(value) FILTER (key = 'publishers') AS publishers,
         max(value) FILTER (key = 'release_date_after') AS after, max(value) FILTER (key = 'release_date_before') AS before,
         max(value) FILTER (key = 'review_score_min') AS least, max(value) FILTER (key = 'review_score_description') AS described
  FROM said SEMI JOIN ready USING (session_id) GROUP BY session_id),
lists AS (
  SELECT session_id, TRY_CAST(after AS TIMESTAMP) AS after, TRY_CAST(before AS TIMESTAMP) AS before,
         TRY_CAST(least AS BIGINT) AS least, described, genres, categories, developers, publishers FROM wanted)"""


def _list(column: str) -> str:
    return (
        f"list_filter(CASE WHEN {column}[1] = '[' THEN from_json({column}, '[\"VARCHAR\"]') WHEN {column} <> '' "
        f"THEN [{column}] ELSE [] END, lambda x: x <> '')"
    )


@workload(
    "search_ready_sessions",
    "V03 V03a V03b V03c V03d V04 F17 F21 F22 K05",
    layered(
        f"""
SELECT session_id, game_id, game_name, game_review_score, row_number() OVER (
           PARTITION BY session_id ORDER BY game_review_score DESC, game_id) AS rank
FROM (SELECT session_id, after, before, least, described, {_list('genres')} AS genres, {_list('categories')} AS categories,
             {_list('developers')} AS developers, {_list('publishers')} AS publishers FROM lists) s
JOIN dim_games ON game_review_score IS NOT NULL AND game_review_score_description IS NOT NULL
  AND len(genres) + len(categories) + len(developers) + len(publishers) > 0
  AND (len(genres) = 0 OR list_has_any(game_genres, genres))
  AND (len(categories) = 0 OR list_has_any(game_categories, categories))
  AND (len(developers) = 0 OR len(list_filter(developers, lambda p: contains(lower(array_to_string(game_developers, '|')), lower(p)))) > 0)
  AND (len(publishers) = 0 OR len(list_filter(publishers, lambda p: contains(lower(array_to_string(game_publishers, '|')), lower(p)))) > 0)
  AND (after IS NULL OR game_prerelease_date >= after) AND (before IS NULL OR game_prerelease_date <= before)
  AND (coalesce(least, 0) = 0 OR game_review_score >= least)
  AND (coalesce(described, '') = '' OR game_review_score_description = described)
QUALIFY rank <= 20""",
        _ASKED.strip(),
    ),
)
def _(spark, d):
    orders = b.table(spark, d, "orders").selectExpr(
        "o_custkey AS session_id", "o_orderkey AS turn", "o_orderkey % 9 AS kind", "o_orderkey DIV 9 AS k"
    )
    said = orders.where("kind < 8").selectExpr(
        "session_id",
        "turn",
        f"element_at(array({', '.join(repr(k) for k in retrieval.PREFERENCE_KEYS[:8])}), CAST(kind + 1 AS INT)) AS key",
        """CASE kind
           WHEN 0 THEN concat('["', element_at(array('STANDARD', 'LARGE', 'PROMO', 'Brand#7', 'None'), CAST(k % 5 + 1 AS INT)),
                              '","Brand#', k % 25, '"]')
           WHEN 1 THEN element_at(array('widget', '["rod","old"]', '[]', 'ring'), CAST(k % 4 + 1 AS INT))
           WHEN 2 THEN element_at(array('BRAND#2', '["#1","ND#9"]', 'x'), CAST(k % 3 + 1 AS INT))
           WHEN 3 THEN element_at(array('econ', 'a', '["promo"]'), CAST(k % 3 + 1 AS INT))
           WHEN 4 THEN concat('199', 4 + k % 3, '-03-01')
           WHEN 5 THEN element_at(array('1996-01-01', 'soon'), CAST(k % 2 + 1 AS INT))
           WHEN 6 THEN CAST(k % 4 * 10 AS STRING)
           WHEN 7 THEN element_at(array('Mixed', '', 'Mostly Positive'), CAST(k % 3 + 1 AS INT)) END AS value""",
    )
    status = orders.selectExpr("session_id", "turn", "'status' AS key", "IF(turn % 5 > 0, 'READY', 'GATHERING') AS value")
    folded = retrieval.fold_preferences(said.unionByName(status))
    return session_search.search_ready_sessions(b.stored_models(spark, d)["dim_games"], folded, limit=20)


# ---- text


def _clean_sql() -> str:
    text = r"regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g')"
    for tag in ("script", "style", "template", "a", "sup", "video", "picture"):
        text = rf"regexp_replace({text}, '(?is)<{tag}(\s[^>]*)?>.*?</{tag}\s*>', ' ', 'g')"
    text = f"regexp_replace({text}, '(?s)<[^>]*>', ' ', 'g')"
    for entity, char in {
        "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "''", "&nbsp;": " ", "&copy;": "©", "&middot;": "·",
        "&amp;": "&",
    }.items():
        text = f"replace({text}, '{entity}', '{char}')"
    return rf"trim(regexp_replace({text}, '[\s\p{{Z}}]+', ' ', 'g'))"


_CLEANED = f"SELECT page_id, {_clean_sql()} AS text FROM pages"


@workload("clean_html", "T01 I11", _CLEANED)
def _(spark, d):
    return b.table(spark, d, "pages").select("page_id", T.clean_html("html").alias("text"))


@workload("clean_html_native", "T01 I11 F15", _CLEANED)
def _(spark, d):
    return b.table(spark, d, "pages").select("page_id", T.clean_html_native("html").alias("text"))


@workload(
    "chunk_fixed",
    "T02 T04",
    r"""
WITH long AS (SELECT doc_id, text, length(text) AS n FROM documents
              WHERE text IS NOT NULL AND regexp_replace(text, '[\s\p{Z}]+', '', 'g') <> ''),
windows AS (SELECT doc_id, text,
                   unnest(range(0, greatest(0, CAST(ceil((n - 256) / 231.0) AS BIGINT)) + 1)) AS chunk_id FROM long)
SELECT doc_id, CAST(chunk_id AS INTEGER) AS chunk_id, substr(text, chunk_id * 231 + 1, 256) AS chunk_text
FROM windows""",
)
def _(spark, d):
    return T.explode_chunks(b.table(spark, d, "documents"), "doc_id", T.chunk_fixed("text"))


@workload(
    "chunk_recursive",
    "T03 T04 Y01",
    r"""
SELECT doc_id, TRUE AS short_enough, TRUE AS inside_text, TRUE AS numbered,
       len(list_distinct(list_filter(string_split_regex(text, '[\s\p{Z}]+'), lambda w: w <> ''))) AS words
FROM documents WHERE regexp_replace(text, '[\s\p{Z}]+', '', 'g') <> ''""",
)
def _(spark, d):
    # where a chunk ends is a matter of the splitter; each is a piece of the text, and together they hold all its words.
    # A text is compared with its chunks in its own row, so neither is exchanged
    def words(text):
        return F.filter(F.split(text, r"[\s\p{Z}]+"), lambda w: w != "")

    documents = b.table(spark, d, "documents").select("doc_id", "text", T.chunk_recursive("text").alias("chunks"))
    both = F.array_intersect(F.array_distinct(words("text")), F.array_distinct(F.flatten(F.transform("chunks", words))))
    document = F.struct(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.forall("chunks", lambda c: F.length(c) <= 256).alias("short_enough"),
        F.forall("chunks", lambda c: F.col("text").contains(c)).alias("inside_text"),
        F.size(both).cast("bigint").alias("words"),
    )
    chunks = T.explode_chunks(documents.select(document.alias("document"), "chunks"), "document", F.col("chunks"))
    numbered = chunks.groupBy("document").agg((F.max("chunk_id") + 1 == F.count("*")).alias("numbered"))
    return numbered.select("document.doc_id", "document.short_enough", "document.inside_text", "numbered", "document.words")


@workload("embed_documents", "T05")
def _(spark, d):
    return T.embed(b.table(spark, d, "documents").select("doc_id", "text"), "text").select("doc_id", "embedding")


@workload("profile_embeddings", "T06")
def _(spark, d):
    return retrieval.profile_embeddings(b.stored_models(spark, d)["dim_games"])


@workload("chunk_embeddings", "T07")
def _(spark, d):
    return retrieval.chunk_embeddings(b.table(spark, d, "documents"), "text", "doc_id")
