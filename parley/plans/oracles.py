"""The same bindings and queries in plain SQL, for an engine that shares no code with Spark."""

from __future__ import annotations

from parley.functions.words import CUTS, IRREGULAR, LETTERS_AND_DIGITS, SEPARATORS, STOP_WORDS, VERB_ENDINGS, VERBS

ISO = "strftime(time, '%Y-%m-%dT%H:%M:%S.000')"

_SECONDS = """(epoch_us({0}) // 1000000)::VARCHAR || '.' || lpad((epoch_us({0}) % 1000000)::VARCHAR, 6, '0')"""
_SNOWFLAKE = "((epoch_us({0}) // 1000 - 1420070400000) * 4194304 + ({1}) % 4096)::VARCHAR"

# -- common table expressions -----------------------------------------------------------------

CTE = {
    "base": f"""
base AS (
  SELECT event_id, block, event_type, value, channel, 'message' AS type,
    CASE event_type WHEN 'signup' THEN 'channel_join' WHEN 'error' THEN 'bot_message'
      WHEN 'purchase' THEN 'thread_broadcast' END AS subtype,
    {_SECONDS.format("ets")} AS ts,
    {_SECONDS.format("root_time")} AS root,
    CASE WHEN NOT apart THEN {_SECONDS.format("root_time")} END AS thread_ts,
    date_trunc('second', ets) AS time, ets, root_time,
    CASE WHEN event_id % 20 = 0 THEN answers END AS reply_count,
    'U' || user_id AS member,
    CASE WHEN event_id % 97 <> 0 THEN 'U' || user_id END AS user_id,
    CASE event_type WHEN 'view' THEN 'note ' || props WHEN 'signup' THEN NULL
      ELSE 'hi <@U' || (event_id * 7 % 1500) || '> and <@U' || user_id || '> in <#' || channel
        || CASE WHEN value > 20 THEN '|general' ELSE '' END || '> see <https://x.y/' || event_id
        || '|doc> or <https://x.y/' || user_id || '>' END AS text
  FROM (
    SELECT *, min(ets) OVER w AS root_time,
      (count(CASE WHEN NOT apart THEN 1 END) OVER w - 1)::INTEGER AS answers
    FROM (
      SELECT event_id, ts AS ets, user_id, event_type, value, props, event_id // 20 AS block,
        event_type = 'view' AND event_id % 20 <> 0 AS apart,
        CASE WHEN (event_id // 20) % 3 = 0 THEN 'C0' ELSE 'C' || ((event_id // 20) % 41) END AS channel
      FROM events)
    WINDOW w AS (PARTITION BY block)))""",
    "message": """
message AS (
  SELECT channel, type, subtype, ts, thread_ts, time, user_id, text FROM base
  UNION ALL
  SELECT 'CX', type, subtype, ts, thread_ts, time, user_id, text FROM base WHERE event_type = 'purchase')""",
    "thread": """
thread AS (
  SELECT channel, type, subtype, ts, thread_ts, time, user_id,
    text || CASE WHEN value > 100 THEN ' (edited)' ELSE '' END AS text
  FROM base WHERE thread_ts IS NOT NULL)""",
    "reaction": """
reaction AS (
  SELECT channel, root AS ts, root AS thread_ts, member AS user_id, event_type AS reaction FROM base)""",
    "users": """
users AS (
  SELECT 'U' || c_custkey AS id, c_name AS name, c_mktsegment || ' ' || c_custkey AS real_name,
    CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'AUTOMOBILE' THEN 'UTC'
      WHEN 'MACHINERY' THEN r_name || '/' || n_name || '/East' ELSE r_name || '/' || n_name END AS tz,
    '' AS email, (1704067200 + c_custkey * 3600)::VARCHAR AS batch
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
    "geo": """
geo AS (
  SELECT u.*, coalesce(k.n_name, split_part(u.tz, '/', 1)) AS country,
    CASE WHEN u.tz LIKE '%/%' THEN split_part(u.tz, '/', 2) END AS city, k.iso
  FROM users u LEFT JOIN (
    SELECT r_name || '/' || n_name AS tz, 'N' || n_nationkey AS iso, n_name
    FROM nation JOIN region ON n_regionkey = r_regionkey) k ON u.tz = k.tz)""",
    "channels": """
channels AS (
  SELECT channel AS id, CASE WHEN channel <> 'C4' THEN 'name-' || channel END AS name,
    CASE WHEN channel = 'CX' THEN 'mpim' WHEN channel LIKE '%7' THEN 'im' ELSE 'channel' END AS type,
    CASE WHEN channel LIKE '%3' THEN 'confidential' ELSE 'public' END AS class,
    'False' AS is_archived, CASE WHEN channel LIKE '%3' THEN 'True' ELSE 'False' END AS is_private
  FROM (SELECT DISTINCT channel FROM message))""",
    "posts": """
posts AS (SELECT * FROM message UNION SELECT * FROM thread)""",
    "act": """
act AS (SELECT * FROM posts WHERE subtype IS NULL OR subtype = 'thread_broadcast')""",
    "act_m": """
act_m AS (SELECT * FROM message WHERE subtype IS NULL OR subtype = 'thread_broadcast')""",
    "message_b": f"""
flake AS (
  SELECT *, {_SNOWFLAKE.format("ets", "event_id")} AS flake FROM base),
message_b AS (
  SELECT channel, type, coalesce(subtype, 'default') AS subtype, flake AS ts, NULL::VARCHAR AS thread_ts,
    time, user_id, replace(text, '<@', '<@!') AS text FROM flake
  UNION ALL
  SELECT 'CX', type, coalesce(subtype, 'default'), flake, NULL, time, user_id, replace(text, '<@', '<@!')
  FROM flake WHERE event_type = 'purchase'),
act_b AS (SELECT * FROM message_b WHERE subtype = 'default')""",
    "reaction_b": f"""
reaction_b AS (
  SELECT channel, {_SNOWFLAKE.format("root_time", "block * 20")} AS ts, member AS user_id,
    event_type AS reaction FROM base)""",
    "batches": """
o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate FROM orders),
master AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, 'b1' AS batch
  FROM o WHERE o_orderdate < TIMESTAMP '1998-07-01'),
incoming AS (
  SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus, o_orderpriority, 'b2' AS batch
  FROM o WHERE o_orderdate >= TIMESTAMP '1997-01-01'),
updated AS (
  SELECT i.o_orderkey, i.o_custkey, i.o_orderstatus, i.o_orderpriority, m.batch
  FROM incoming i JOIN master m ON i.o_orderkey = m.o_orderkey),
inserted AS (SELECT * FROM incoming WHERE o_orderkey NOT IN (SELECT o_orderkey FROM master)),
kept AS (SELECT * FROM master WHERE o_orderkey NOT IN (SELECT o_orderkey FROM incoming))""",
    "gratitude": """
gratitude AS (
  SELECT doc_id, text || CASE WHEN lang = 'en' THEN ' Thanks, I can''t thank you enough.'
    WHEN source = 'src3' THEN ' thx cannot wait' ELSE '' END AS text FROM documents)""",
}

_MESSAGE = ["base", "message"]
_POSTS = [*_MESSAGE, "thread", "posts"]
_ACT = [*_POSTS, "act"]


def _sql(parts: list[str], select: str) -> str:
    return "WITH " + ",".join(CTE[p] for p in parts) + "\n" + select


# The batch of an order, by its year.
_BATCH = "CASE WHEN year(o_orderdate) < 1994 THEN 1 WHEN year(o_orderdate) < 1996 THEN 2 ELSE 3 END"


# -- text ---------------------------------------------------------------------------------------


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(items) -> str:
    return "(" + ", ".join(_quoted(i) for i in items) + ")"


def _chunk_tokens(chunk: str) -> str:
    cut = chunk
    for pattern, replacement in CUTS:
        new = replacement.replace("$", "\\")
        cut = f"regexp_replace({cut}, {_quoted(pattern)}, {_quoted(new)}, 'g')"
    return (
        f"list_filter(string_split({cut}, ' '),"
        f" lambda t: regexp_matches(t, {_quoted(LETTERS_AND_DIGITS)}))"
    )


def _tokens(source: str, key: str) -> str:
    """Rows (key, place, spot, token) without stop words."""
    return f"""
chunks AS (
  SELECT {key} AS k, unnest(regexp_split_to_array(text, {_quoted(SEPARATORS)})) AS chunk,
    generate_subscripts(regexp_split_to_array(text, {_quoted(SEPARATORS)}), 1) AS place
  FROM {source}),
pieces AS (SELECT k, place, {_chunk_tokens("chunk")} AS ts FROM chunks),
words AS (
  SELECT * FROM (
    SELECT k, place, unnest(ts) AS token, generate_subscripts(ts, 1) AS spot FROM pieces)
  WHERE token NOT IN {_list(STOP_WORDS)})"""


def _lemma(word: str) -> str:
    exceptions = " ".join(f"WHEN {_quoted(a)} THEN {_quoted(b)}" for a, b in IRREGULAR.items())
    candidates = [word, f"CASE {word} {exceptions} END"]
    for ending, replacement in VERB_ENDINGS:
        stem = f"left({word}, length({word}) - {len(ending)})"
        candidates.append(
            f"CASE WHEN {word} LIKE '%{ending}' AND {word} NOT IN {_list(IRREGULAR)}"
            f" THEN {stem} || '{replacement}' END"
        )
    known = f"list_filter([{', '.join(candidates)}], lambda c: c IN {_list(VERBS)})"
    # Sorting is stable only through the position in the list.
    ranked = f"list_sort(list_transform({known}, lambda c, i: {{'n': length(c), 'i': i, 'c': c}}))"
    return f"coalesce({ranked}[1].c, {word})"


_DIFF = "channel, ts, thread_ts, user_id, text"


def _diff(source: str, partition: str, null_key: str = "false") -> str:
    return f"""
SELECT {_DIFF}, CASE WHEN {null_key} THEN 0.0 ELSE coalesce(epoch(time) - epoch(lag(time) OVER (
  PARTITION BY {partition} ORDER BY ts::DECIMAL(38,6), channel, text NULLS FIRST)), 0.0) END::DOUBLE AS diff
FROM {source}"""


def _timed(columns: str) -> str:
    return f"{columns}, {ISO} AS time"


_POST = "channel, type, subtype, ts, thread_ts, user_id, text"

_INTERACTS = """
SELECT c.channel, c.user_id AS source, coalesce(p.user_id, c.channel) AS target,
  strftime(c.time, '%Y-%m-%dT%H:%M:%S.000') AS time, 'interacts' AS relate
FROM act_m c LEFT JOIN (SELECT * FROM act_m WHERE thread_ts IS NOT NULL) p
  ON c.thread_ts = p.ts {extra}
WHERE coalesce(c.user_id <> p.user_id, true)"""

_MENTIONS = """
SELECT channel, ts, tag, u.real_name AS nice_tag, 'user' AS type FROM (
  SELECT channel, ts, unnest(regexp_extract_all(text, '{user}', 1)) AS tag FROM {act}) m
LEFT JOIN users u ON m.tag = u.id"""

_LABELLED = """
SELECT channel, ts, split_part(m, '|', 1) AS tag,
  CASE WHEN contains(m, '|') THEN split_part(m, '|', 2) END AS nice_tag, '{kind}' AS type
FROM (SELECT channel, ts, unnest(regexp_extract_all(text, '{pattern}', 1)) AS m FROM act) {where}"""

_TAGS = (
    _MENTIONS.format(user="<@(.*?)>", act="act")
    + "\nUNION ALL"
    + _LABELLED.format(kind="channel", pattern="<#(.*?)>", where="")
    + "\nUNION ALL"
    + _LABELLED.format(kind="link", pattern="<(.*?)>", where="WHERE regexp_matches(m, '^[^@#]')")
)

_UNTIMED_REACTS = """
SELECT m.channel, m.user_id AS source, r.user_id AS target, 'reacts' AS relate
FROM act_b m JOIN reaction_b r ON m.ts = r.ts"""
_UNTIMED_REFERS = """
SELECT m.channel, m.user_id AS source, t.tag AS target, 'refers' AS relate
FROM act_b m JOIN (
  SELECT ts, unnest(regexp_extract_all(text, '<@!(.*?)>', 1)) AS tag FROM act_b) t ON m.ts = t.ts
WHERE m.user_id IS NOT NULL"""
_TEAMS = "SELECT channel, user_id AS source, channel AS target, 'teams' AS relate FROM act_b"

_TOP = """
SELECT n.channel AS channel_id, c.name AS channel_name, n.user_id, u.real_name AS user_name, n.ts
FROM (
  SELECT *, rank() OVER (PARTITION BY channel ORDER BY ts DESC) AS r
  FROM (SELECT channel, user_id, count(ts) AS ts FROM {act} WHERE user_id IS NOT NULL GROUP BY 1, 2)) n
LEFT JOIN users u ON n.user_id = u.id LEFT JOIN channels c ON n.channel = c.id
WHERE n.r = 1"""

_MEMBERS = """
SELECT u.id AS user_id, {name} {invite} AS invite_date, p.join_date, p.message_count,
  p.first_message_date, p.last_message_date, r.reaction_count, r.first_reaction_date, r.last_reaction_date
FROM users u LEFT JOIN (
  SELECT user_id, arg_min(ts, ts::DECIMAL(38,6)) AS join_date,
    nullif(count(*) FILTER (WHERE {active}), 0) AS message_count,
    arg_min(ts, ts::DECIMAL(38,6)) FILTER (WHERE {active}) AS first_message_date,
    arg_max(ts, ts::DECIMAL(38,6)) FILTER (WHERE {active}) AS last_message_date
  FROM {posts} WHERE user_id IS NOT NULL GROUP BY 1) p ON u.id = p.user_id
LEFT JOIN (
  SELECT user_id, count(*) AS reaction_count, arg_min(ts, ts::DECIMAL(38,6)) AS first_reaction_date,
    arg_max(ts, ts::DECIMAL(38,6)) AS last_reaction_date
  FROM {reactions} GROUP BY 1) r ON u.id = r.user_id"""

_PEOPLE = """,
people AS (SELECT channel, user_id, count(*) AS n FROM act_b GROUP BY 1, 2)"""

_CONVERSATION = f"""
SELECT channel, type, subtype, ts, thread_ts, ts::DOUBLE AS ts_int, {ISO} AS time, user_id,
  real_name, name, text, city, country, iso"""


_MASTER = f"""
SELECT o_orderpriority AS channel, o_custkey::VARCHAR AS ts, '' AS thread_ts, o_orderkey::VARCHAR AS user_id,
  o_orderstatus AS reaction
FROM (SELECT *, {_BATCH} AS b, max({_BATCH}) OVER (PARTITION BY o_custkey) AS last FROM orders) WHERE b = last"""

_FEED = """
SELECT DISTINCT year(o_orderdate) AS batch_id,
  CASE WHEN min(year(o_orderdate)) OVER (PARTITION BY o_custkey) < year(o_orderdate) THEN 'update' ELSE 'insert' END AS change,
  o_custkey, o_orderkey, o_orderstatus FROM orders"""


def oracles() -> dict[str, str]:
    members = [*_POSTS, "reaction", "users"]
    b = ["base", "message_b"]
    active = "subtype IS NULL OR subtype = 'thread_broadcast'"
    return {
        "count_by_channel": _sql(_ACT, "SELECT channel, count(ts) AS ts, count(thread_ts) AS thread_ts FROM act GROUP BY 1"),
        "count_by_channel_user": _sql(
            _ACT,
            "SELECT channel, user_id, count(ts) AS ts, count(thread_ts) AS thread_ts FROM act"
            " WHERE user_id IS NOT NULL GROUP BY 1, 2",
        ),
        "users_per_channel": _sql(_ACT, "SELECT channel, count(DISTINCT user_id) AS user_id FROM act WHERE user_id IS NOT NULL GROUP BY 1"),
        "users_per_channel_merged": _sql(_ACT, "SELECT channel, count(DISTINCT user_id) AS user_id FROM act WHERE user_id IS NOT NULL GROUP BY 1"),
        "max_per_channel": _sql(
            _ACT,
            "SELECT channel, max(n) AS ts FROM (SELECT channel, user_id, count(ts) AS n FROM act"
            " WHERE user_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1",
        ),
        "top_users_per_channel": _sql([*_ACT, "users", "channels"], _TOP.format(act="act")),
        "count_by_thread": _sql(_POSTS, "SELECT channel, thread_ts, count(ts) AS ts FROM posts WHERE thread_ts IS NOT NULL GROUP BY 1, 2"),
        "count_by_thread_user": _sql(
            _POSTS,
            "SELECT channel, thread_ts, user_id, count(ts) AS ts FROM posts"
            " WHERE thread_ts IS NOT NULL AND user_id IS NOT NULL GROUP BY 1, 2, 3",
        ),
        "count_by_channel_b": _sql(b, "SELECT channel, count(ts) AS ts FROM act_b GROUP BY 1"),
        "top_users_per_channel_b": _sql([*_MESSAGE, "message_b", "users", "channels"], _TOP.format(act="act_b")),
        "activity_posts": _sql(_ACT, f"SELECT {_timed(_POST)} FROM act"),
        "threaded_posts": _sql(_POSTS, f"SELECT {_timed(_POST)} FROM posts WHERE thread_ts IS NOT NULL"),
        "posts_prefer_thread": _sql(
            [*_MESSAGE, "thread"],
            f"SELECT {_timed(_POST)} FROM (SELECT * FROM message m WHERE NOT EXISTS (SELECT 1 FROM thread t"
            " WHERE t.channel = m.channel AND t.ts = m.ts) UNION SELECT * FROM thread)",
        ),
        "conversations": _sql([*_POSTS, "users", "geo"], _CONVERSATION + " FROM posts LEFT JOIN geo ON user_id = id"),
        "conversations_b": _sql(
            [*b, "users"],
            _CONVERSATION
            + " FROM (SELECT DISTINCT * FROM message_b) LEFT JOIN (SELECT id, name, real_name, '' AS city,"
            " '' AS country, '' AS iso FROM users) ON user_id = id",
        ),
        "user_geo": _sql(["users", "geo"], "SELECT * FROM geo"),
        "user_activity": _sql(
            members,
            _MEMBERS.format(
                name="u.name,",
                invite="CASE WHEN u.batch::DOUBLE > p.join_date::DOUBLE THEN p.join_date ELSE u.batch END",
                active=active, posts="posts", reactions="reaction",
            ),
        ),
        "user_activity_b": _sql(
            [*b, "reaction_b", "users"],
            _MEMBERS.format(name="", invite="u.batch", active="subtype = 'default'", posts="message_b", reactions="reaction_b"),
        ),
        "timediff_conversations": _sql(_POSTS, _diff("posts", "channel")),
        "timediff_sliced": _sql(_POSTS, _diff("posts", "channel")),
        "timediff_threads": _sql(_POSTS, _diff("(SELECT * FROM posts WHERE thread_ts IS NOT NULL)", "channel, thread_ts")),
        "timediff_users": _sql(_POSTS, _diff("(SELECT * FROM posts WHERE thread_ts IS NOT NULL)", "user_id", "user_id IS NULL")),
        "timediff_users_b": _sql(b, _diff("message_b", "user_id", "user_id IS NULL")),
        "extract_tags": _sql([*_ACT, "users"], _TAGS),
        "extract_tags_b": _sql([*b, "users"], _MENTIONS.format(user="<@!(.*?)>", act="act_b")),
        "nodes": _sql(
            [*_MESSAGE, "users", "geo", "channels"],
            """
SELECT id, name AS label, 'user' AS type, real_name AS name, iso, country, city,
  NULL::VARCHAR AS channel_type, NULL::VARCHAR AS channel_class FROM geo
UNION ALL
SELECT id, coalesce(name, id), 'channel', coalesce(name, id), NULL, NULL, NULL, type, class FROM channels""",
        ),
        "nodes_b": _sql(
            [*_MESSAGE, "users", "channels"],
            """
SELECT id, coalesce(name, real_name) AS label, 'user' AS type, real_name AS name, '' AS iso,
  '' AS country, '' AS city, NULL::VARCHAR AS channel_type, NULL::VARCHAR AS channel_class FROM users
UNION ALL
SELECT id, coalesce(name, id), 'channel', coalesce(name, id), NULL, NULL, NULL, type, class FROM channels""",
        ),
        "edges_interacts": _sql([*_MESSAGE, "act_m"], _INTERACTS.format(extra="")),
        "edges_interacts_in_channel": _sql([*_MESSAGE, "act_m"], _INTERACTS.format(extra="AND c.channel = p.channel")),
        "edges_reacts": _sql(
            [*_MESSAGE, "act_m", "reaction"],
            f"SELECT m.channel, m.user_id AS source, r.user_id AS target, {ISO}, 'reacts' AS relate"
            " FROM act_m m JOIN reaction r ON m.ts = r.ts".replace(ISO, ISO + " AS time"),
        ),
        "edges": _sql(
            [*_MESSAGE, "act_m", "reaction"],
            f"{_INTERACTS.format(extra='')} UNION ALL"
            f" SELECT m.channel, m.user_id, r.user_id, {ISO}, 'reacts' FROM act_m m JOIN reaction r ON m.ts = r.ts UNION ALL"
            f" SELECT m.channel, m.user_id, t.tag, {ISO}, 'refers' FROM act_m m"
            " JOIN (SELECT ts, unnest(regexp_extract_all(text, '<@(.*?)>', 1)) AS tag FROM act_m) t"
            " ON m.ts = t.ts WHERE m.user_id IS NOT NULL",
        ),
        "edges_refers": _sql(
            [*_MESSAGE, "act_m"],
            f"SELECT m.channel, m.user_id AS source, t.tag AS target, {ISO} AS time, 'refers' AS relate"
            " FROM act_m m JOIN (SELECT ts, unnest(regexp_extract_all(text, '<@(.*?)>', 1)) AS tag FROM act_m) t"
            " ON m.ts = t.ts WHERE m.user_id IS NOT NULL",
        ),
        "edges_teams": _sql(b, _TEAMS),
        "edges_untimed_b": _sql([*b, "reaction_b"], f"{_TEAMS} UNION ALL {_UNTIMED_REACTS} UNION ALL {_UNTIMED_REFERS}"),
        "edges_interacts_b": _sql(
            b,
            """
SELECT x.channel, x.user_id AS source, 'interacts' AS relate, x.n AS messages,
  count(*) AS targets, sum(x.n * y.n)::BIGINT AS edges
FROM (SELECT channel, user_id, count(*) AS n FROM act_b GROUP BY 1, 2) x
JOIN (SELECT channel, user_id, count(*) AS n FROM act_b GROUP BY 1, 2) y
  ON x.channel = y.channel AND coalesce(x.user_id <> y.user_id, true)
GROUP BY ALL""",
        ),
        "interacts_of": _sql(
            b,
            """
SELECT x.channel, x.user_id AS source, y.user_id AS target, 'interacts' AS relate, x.n * y.n AS weight
FROM (SELECT channel, user_id, count(*) AS n FROM act_b GROUP BY 1, 2) x
JOIN (SELECT channel, user_id, count(*) AS n FROM act_b GROUP BY 1, 2) y
  ON x.channel = y.channel AND coalesce(x.user_id <> y.user_id, true)
WHERE x.user_id IN (SELECT arg_max(user_id, ts::DECIMAL(38,6)) FROM message_b
  WHERE subtype = 'channel_join' GROUP BY channel)""",
        ),
        "upsert_unique": _sql(["batches"], "SELECT * FROM kept UNION ALL SELECT * FROM inserted UNION ALL SELECT * FROM updated"),
        "upsert_group": _sql(
            ["batches"],
            "SELECT * FROM master WHERE o_custkey NOT IN (SELECT o_custkey FROM incoming) UNION ALL SELECT * FROM incoming",
        ),
        "upsert_insert_delta": _sql(["batches"], "SELECT * FROM inserted"),
        "upsert_update_delta": _sql(["batches"], "SELECT * FROM updated"),
        "merge_counts": _sql(
            ["batches"],
            "SELECT 'insert' AS change, count(*) AS rows FROM inserted UNION ALL SELECT 'update', count(*) FROM updated"
            " UNION ALL SELECT 'unchanged', count(*) FROM kept",
        ),
        "replay": """
SELECT o_custkey, o_orderkey, o_orderstatus FROM (
  SELECT *, max(year(o_orderdate)) OVER (PARTITION BY o_custkey) AS last FROM orders)
WHERE year(o_orderdate) = last""",
        "change_feed": _FEED,
        "feed_counts": f"""
SELECT batch_id, count(*) FILTER (change = 'insert') AS inserted, count(*) FILTER (change = 'update') AS updated
FROM ({_FEED}) GROUP BY 1""",
        "change_feed_first_seen": """
WITH b AS (SELECT l_orderkey, l_linenumber AS batch_id, max(l_linestatus) AS state, max(l_partkey) AS part
  FROM lineitem GROUP BY 1, 2)
SELECT batch_id, CASE WHEN min(batch_id) OVER o < batch_id THEN 'update' ELSE 'insert' END AS change,
  l_orderkey, state, part, arg_min(part, batch_id) OVER o AS first_part
FROM b WINDOW o AS (PARTITION BY l_orderkey)""",
        "user_hash": _sql(_POSTS, "SELECT user_id, count(*) AS rows, count(DISTINCT user_id) AS users FROM posts GROUP BY 1"),
        "master_of_batches": _MASTER,
        "master_from_base": _MASTER,
        "master_of_users": f"""
SELECT o_custkey::VARCHAR AS id, arg_max(o_orderkey, ({_BATCH}, o_orderkey))::VARCHAR AS name, '' AS real_name,
  '' AS tz, '' AS email, min({_BATCH})::VARCHAR AS batch FROM orders GROUP BY o_custkey""",
        "replay_first_seen": """
WITH b AS (SELECT l_orderkey, l_linenumber AS n, max(l_linestatus) AS state, max(l_partkey) AS part
  FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, arg_max(state, n) AS state, arg_max(part, n) AS part, arg_min(part, n) AS first_part
FROM b GROUP BY 1""",
        "decode_literal_pages": _sql(
            ["base"],
            "SELECT channel, epoch_us(root_time) AS page_clock, count(*) AS messages FROM base GROUP BY 1, 2",
        ),
        "reply_page_keys": _sql(
            ["base"],
            "SELECT DISTINCT 'conversation_replies-' || channel || '_' || root || '-' || epoch_us(root_time) || '.json'"
            " AS file_name, channel, root AS parent_ts, epoch_us(root_time) AS page_clock FROM base"
            " WHERE thread_ts IS NOT NULL",
        ),
        "unreadable_pages": "SELECT page_id::VARCHAR AS file_name, 'undecodable' AS reason FROM pages UNION ALL"
        " SELECT DISTINCT 'user_list-all-' || lpad((1704067200000000 + c_custkey // 100)::VARCHAR, 16, '0') || '.json',"
        " 'no list of messages' FROM customer",
        "normalize_pages": _sql(["base"], "SELECT channel, ts, text FROM base"),
        "process_each_page": _sql(
            ["base"],
            "SELECT 'conversation_history-' || channel || '-' || epoch_us(root_time) || '.json' AS file_name,"
            " count(*) AS messages, count(user_id) AS known FROM base GROUP BY 1",
        ),
        "users_from_pages": _sql(
            ["users"],
            "SELECT id, name, real_name, tz, id || '@x.y' AS email,"
            " (epoch(TIMESTAMP '2024-02-02'))::BIGINT::VARCHAR AS batch FROM users",
        ),
        "page_offset_index": "SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS index, 'U' || c_custkey AS id FROM customer",
        "channels_from_pages": """
SELECT 'C' || s_suppkey AS id, CASE WHEN s_nationkey <> 4 THEN s_name ELSE '' END AS name,
  CASE WHEN s_nationkey >= 20 THEN 'im' WHEN s_nationkey >= 12 THEN 'mpim' ELSE 'channel' END AS type,
  CASE WHEN s_nationkey <> 7 AND s_nationkey % 2 = 0 THEN 'confidential' ELSE 'public' END AS class,
  CASE WHEN s_acctbal < 0 THEN 'True' ELSE 'False' END AS is_archived,
  CASE WHEN s_nationkey = 7 OR s_nationkey % 2 = 0 THEN 'True' ELSE 'False' END AS is_private
FROM supplier""",
        "messages_from_pages": _sql(["base"], f"SELECT {_POST}, reply_count, {ISO} AS time FROM base"),
        "threads_from_pages": _sql(
            ["base"],
            f"SELECT {_POST}, {ISO} AS time FROM base WHERE thread_ts IS NOT NULL"
            " AND block IN (SELECT block FROM base WHERE reply_count > 0)",
        ),
        "reactions_from_messages": _sql(
            ["base"],
            """
SELECT DISTINCT channel, ts, coalesce(thread_ts, '') AS thread_ts, unnest([member, 'U0']) AS user_id,
  event_type AS reaction
FROM base WHERE event_type <> 'view' AND (coalesce(reply_count, 0) = 0
  OR (thread_ts IS NOT NULL AND block IN (SELECT block FROM base WHERE reply_count > 0)))""",
        ),
        "files_from_pages": """
SELECT 'F' || page_id AS id, unnest(['C1', 'C' || (page_id % 41)]) AS channel, url AS name,
  strftime(make_timestamp((1704067200 + page_id * 61) * 1000000), '%Y-%m-%dT%H:%M:%S.000') AS time,
  'U' || (page_id % 150) AS user_id
FROM pages WHERE url NOT LIKE 'http:%' AND NOT contains(url, '#')""",
        "polls_from_pages": _sql(
            ["base"],
            f"""
SELECT CASE WHEN menu IS NOT NULL THEN 'poll-' || menu END AS poll_id, ts, {ISO} AS time,
  'Poll ' || menu AS text, 'Option ' || event_id AS vote_item,
  CASE WHEN value > 20 THEN 3 ELSE 0 END AS vote_count
FROM (SELECT *, max(CASE WHEN event_type = 'purchase' THEN event_id END) OVER (
  PARTITION BY block ORDER BY event_id) AS menu FROM base)
WHERE event_type = 'click'""",
        ),
        "read_chat_b_users": _sql(
            ["users"], "SELECT id, name, real_name, '' AS tz, email, '20240201000000' AS batch FROM users"
        ),
        "read_chat_b_channels": """
SELECT s_suppkey::VARCHAR AS id, s_name AS name, 'text' AS type,
  CASE WHEN s_nationkey >= 12 THEN 'private' ELSE 'public' END AS class, 'False' AS is_archived,
  CASE WHEN s_nationkey >= 12 THEN 'True' ELSE 'False' END AS is_private
FROM supplier""",
        "read_chat_b_messages": _sql(
            ["base", "message_b"],
            f"SELECT channel, type, coalesce(subtype, 'default') AS subtype, flake AS ts, NULL::VARCHAR AS thread_ts,"
            f" {ISO} AS time, NULL::INTEGER AS reply_count, member AS user_id, coalesce(text, '') AS text FROM flake",
        ),
        "read_chat_b_files": """
SELECT page_id::VARCHAR AS id, (page_id % 41)::VARCHAR AS channel, url AS name,
  '2024-01-01T00:00:00.000' AS time, (page_id % 150)::VARCHAR AS user_id FROM pages""",
        "redact_private": _sql(
            _MESSAGE,
            f"SELECT channel, type, subtype, ts, thread_ts, user_id, {ISO} AS time,"
            " CASE WHEN text IS NOT NULL AND (channel = 'CX' OR channel LIKE '%7' OR channel LIKE '%3')"
            " THEN '' ELSE text END AS text FROM message",
        ),
        "private_channels": "SELECT 'C' || s_suppkey AS channel FROM supplier WHERE s_nationkey >= 12 OR (s_nationkey <> 7 AND s_nationkey % 2 = 0)",
        "channel_class_b": """
SELECT channel_id, class, class = 'private' AS is_private FROM (
  SELECT c_custkey::VARCHAR AS channel_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'public'
    WHEN (c_nationkey % 3 = 0 AND c_nationkey % 5 = 0) OR c_nationkey % 4 = 1 THEN 'public'
    WHEN c_nationkey % 6 = 2 THEN 'private'
    WHEN c_nationkey = 0 OR c_nationkey % 7 = 3 THEN 'public'
    WHEN c_nationkey % 7 = 4 THEN 'private' ELSE 'protected' END AS class FROM customer)""",
        "snowflake_time": """
SELECT event_id, (epoch_us(ts) // 1000 - 1420070400000) * 4194304 + event_id % 4096 AS snowflake,
  epoch_us(ts) // 1000 AS created_ms FROM events""",
        "invite_epoch": "SELECT o_orderkey, epoch(date_trunc('day', o_orderdate) - INTERVAL 1 DAY)::BIGINT::VARCHAR AS invite FROM orders",
        "size_varchar": "SELECT 'text VARCHAR(' || greatest(d.a, c.a, 1) || '), lang VARCHAR(' || greatest(d.b, c.b, 1) ||"
        " '), source VARCHAR(' || greatest(d.c, 1) || ')' AS types FROM (SELECT max(strlen(text)) AS a, max(strlen(lang)) AS b,"
        " max(strlen(source)) AS c FROM documents) d, (SELECT max(length(text)) AS a, max(length(role)) AS b FROM conversations) c",
        "row_index": _sql(
            ["batches"],
            "SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS index, o_orderkey FROM"
            " (SELECT * FROM kept UNION ALL SELECT * FROM inserted UNION ALL SELECT * FROM updated)",
        ),
        "token_frequency": f"WITH {_tokens('documents', 'doc_id')} SELECT token, count(*) AS n FROM words GROUP BY 1 ORDER BY n DESC, token LIMIT 30",
        "token_frequency_chats": f"WITH {_tokens('conversations', 'conv_id')} SELECT token, count(*) AS n FROM words GROUP BY 1 ORDER BY n DESC, token LIMIT 30",
        "word_forms": _sql(
            ["gratitude"],
            f"SELECT token, count(*) AS n, {_lemma('token')} AS lemma FROM words GROUP BY 1",
        ).replace("\nSELECT token", f",{_tokens('gratitude', 'doc_id')}\nSELECT token"),
        "word_stems": _sql(
            ["gratitude"],
            "SELECT token, count(*) AS n, CASE WHEN token LIKE '%s' THEN left(token, length(token) - 1) ELSE token END AS stem"
            " FROM words GROUP BY 1",
        ).replace("\nSELECT token", f",{_tokens('gratitude', 'doc_id')}\nSELECT token"),
        "thank_you_posts": _sql(
            ["gratitude"],
            f"""SELECT g.doc_id, coalesce(l.lemmas, '') AS lemmas FROM gratitude g LEFT JOIN (
  SELECT k, string_agg(lemma, ' ' ORDER BY place, spot) AS lemmas FROM (
    SELECT k, place, spot, {_lemma("lower(token)")} AS lemma FROM words)
  GROUP BY k HAVING bool_or(lemma IN ('thank', 'thx'))) l ON g.doc_id = l.k""",
        ).replace("\nSELECT g.doc_id", f",{_tokens('gratitude', 'doc_id')}\nSELECT g.doc_id"),
    }
