"""Answer parsing and prompt building over text made from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from timbrel.functions import chat, parse
from timbrel.operators.results import script_result, unpivot_layers
from timbrel.plans.registry import query, table
from timbrel.schemas import LAYERS

# Every case of the layer parser occurs in this text rule (plain SQL for both engines).
LAYER_TEXT = """CASE p_partkey % 12
    WHEN 0 THEN '{"background": ["' || p_brand || '", "' || p_type || '"], "middle_ground": ["piano"], "foreground": ["' || p_name || '"]}'
    WHEN 1 THEN 'Part ' || p_partkey || chr(10) || '{"background": ["' || p_name || '"], "middle_ground": [], "foreground": ["' || p_type || '"]}' || chr(9) || '-- ' || p_brand
    WHEN 2 THEN '{"background": [], "middle_ground": [], "foreground": []}'
    WHEN 3 THEN '{"background": ["' || p_type || '"]}'
    WHEN 4 THEN 'I hear ' || p_name
    WHEN 5 THEN '{"background": ["' || p_name || '"'
    WHEN 6 THEN '{"background": ["a"]} and {"foreground": ["b"]}'
    WHEN 7 THEN '{"background": null, "middle_ground": ["' || p_brand || '"]}'
    WHEN 8 THEN '} {'
    WHEN 9 THEN '{"background": "' || p_name || '", "foreground": ["x"]}'
    WHEN 10 THEN '{"background": ["' || p_brand || '", "' || p_brand || '"], "foreground": ["' || p_brand || '", "solo"]}'
    ELSE '{' || chr(39) || 'background' || chr(39) || ': [' || chr(39) || 'pad' || chr(39) || ']}' END"""

_LAYER_SQL = f"""
    raw AS (SELECT p_partkey, regexp_extract({LAYER_TEXT}, '(?s)\\{{.*\\}}', 0) AS body FROM part),
    valid AS (SELECT p_partkey, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS j FROM raw),
    typed AS (
        SELECT p_partkey, j,
               json_type(j, '$.background') AS tb, json_type(j, '$.middle_ground') AS tm,
               json_type(j, '$.foreground') AS tf FROM valid)"""


def _layer_sql(name: str, short: str, sound: str) -> str:
    return (
        f"CASE WHEN {sound} AND {short} = 'ARRAY' THEN from_json(json_extract(j, '$.{name}'), '[\"VARCHAR\"]') "
        f"ELSE CAST([] AS VARCHAR[]) END AS {name}"
    )


_SOUND = "j IS NOT NULL AND coalesce(tb, 'ARRAY') = 'ARRAY' AND coalesce(tm, 'ARRAY') = 'ARRAY' AND coalesce(tf, 'ARRAY') = 'ARRAY'"
_STRICT_SQL = f"""{_LAYER_SQL},
    layers AS (SELECT p_partkey, {_layer_sql('background', 'tb', _SOUND)},
                      {_layer_sql('middle_ground', 'tm', _SOUND)}, {_layer_sql('foreground', 'tf', _SOUND)} FROM typed)"""


def _parsed(spark, folder):
    answers = table(spark, folder, "part").select("p_partkey", F.expr(LAYER_TEXT).alias("answer"))
    layers = answers.select("p_partkey", parse.parse_layers(F.col("answer")).alias("layers"))
    return layers.select("p_partkey", "layers.*", F.array_sort(parse.flatten_layers(F.col("layers"))).alias("instruments"))


@query(
    "parse_layers",
    f"""
    WITH {_STRICT_SQL}
    SELECT p_partkey, array_to_string(background, '|') AS background, array_to_string(middle_ground, '|') AS middle_ground,
           array_to_string(foreground, '|') AS foreground,
           array_to_string(list_sort(list_distinct(background || middle_ground || foreground)), '|') AS instruments,
           len(background) AS n_background
    FROM layers""",
)
def parse_layers(spark, folder):
    parsed = _parsed(spark, folder)
    return parsed.select(
        "p_partkey",
        *[F.array_join(n, "|").alias(n) for n in (*LAYERS, "instruments")],
        F.size("background").cast("bigint").alias("n_background"),
    )


def _lenient_sql(name: str, short: str) -> str:
    return (
        f"CASE WHEN j IS NULL OR {short} IS NULL THEN '' WHEN {short} = 'ARRAY' "
        f"THEN array_to_string(from_json(json_extract(j, '$.{name}'), '[\"VARCHAR\"]'), '|') END AS {name}"
    )


@query(
    "parse_layers_lenient",
    f"""
    WITH {_LAYER_SQL}
    SELECT p_partkey, {_lenient_sql('background', 'tb')}, {_lenient_sql('middle_ground', 'tm')},
           {_lenient_sql('foreground', 'tf')} FROM typed""",
)
def parse_layers_lenient(spark, folder):
    answers = table(spark, folder, "part").select("p_partkey", F.expr(LAYER_TEXT).alias("answer"))
    layers = answers.select("p_partkey", parse.parse_layers_lenient(F.col("answer")).alias("l"))
    return layers.select("p_partkey", *[F.array_join(F.col(f"l.{n}"), "|").alias(n) for n in LAYERS])


@query(
    "script_rows",
    f"""
    WITH {_LAYER_SQL},
    l AS (SELECT p_partkey, {_lenient_sql('background', 'tb')}, {_lenient_sql('middle_ground', 'tm')},
                 {_lenient_sql('foreground', 'tf')} FROM typed)
    SELECT l.*, 'songs/' || p.p_name || '.' || p.p_partkey || '.wav' AS filename, p.p_name || '.' || p.p_partkey AS song_name,
           p.p_type AS planning_response, {LAYER_TEXT.replace('p_', 'p.p_')} AS raw_response
    FROM l JOIN part p ON p.p_partkey = l.p_partkey""",
)
def script_rows(spark, folder):
    answers = table(spark, folder, "part").withColumns(
        {"answer": F.expr(LAYER_TEXT), "path": F.expr("'songs/' || p_name || '.' || p_partkey || '.wav'")}
    )
    rows = script_result(answers, F.col("path"), F.col("p_type"), F.col("answer"), "p_partkey")
    return rows.withColumns({n: F.array_join(n, "|") for n in LAYERS})


@query(
    "layer_unpivot",
    f"""
    WITH {_STRICT_SQL}
    SELECT p_partkey, 'background' AS layer, array_to_string(background, '|') AS instruments FROM layers
    UNION ALL SELECT p_partkey, 'middle_ground', array_to_string(middle_ground, '|') FROM layers
    UNION ALL SELECT p_partkey, 'foreground', array_to_string(foreground, '|') FROM layers""",
)
def layer_unpivot(spark, folder):
    rows = unpivot_layers(_parsed(spark, folder).select("p_partkey", *LAYERS), "p_partkey")
    return rows.select("p_partkey", "layer", F.array_join("instruments", "|").alias("instruments"))


LIST_TEXT = """CASE p_partkey % 7
    WHEN 0 THEN 'I hear [' || chr(39) || p_brand || chr(39) || ', ' || chr(39) || p_type || chr(39) || '] here'
    WHEN 1 THEN ' just ' || p_name || chr(10)
    WHEN 2 THEN '[' || chr(39) || p_name || chr(39)
    WHEN 3 THEN '["' || p_name || '", "' || p_name || '", "bass"]'
    WHEN 4 THEN '[]'
    WHEN 5 THEN '[' || chr(39) || 'a' || chr(39) || '] or [' || chr(39) || 'b' || chr(39) || ']'
    ELSE '] none [' END"""
_LIST_SQL = f"""
    t AS (SELECT p_partkey, {LIST_TEXT} AS answer FROM part),
    s AS (SELECT *, replace(regexp_extract(answer, '(?s)\\[.*\\]', 0), chr(39), '"') AS body FROM t),
    l AS (SELECT *, CASE WHEN body <> '' AND json_valid(body) THEN from_json(CAST(body AS JSON), '["VARCHAR"]') END AS items
          FROM s)"""


@query(
    "parse_list",
    f"""
    WITH {_LIST_SQL}
    SELECT p_partkey, coalesce(array_to_string(items, '|'), trim(answer, ' ' || chr(10))) AS items,
           coalesce(len(items), 1) AS n FROM l""",
)
def parse_list(spark, folder):
    answers = table(spark, folder, "part").select("p_partkey", F.expr(LIST_TEXT).alias("answer"))
    items = answers.select("p_partkey", parse.parse_list(F.col("answer")).alias("l"))
    return items.select("p_partkey", F.array_join("l", "|").alias("items"), F.size("l").cast("bigint").alias("n"))


@query(
    "parse_set",
    f"""
    WITH {_LIST_SQL}
    SELECT p_partkey, coalesce(array_to_string(list_sort(list_distinct(items)), '|'), '') AS items,
           coalesce(len(list_distinct(items)), 0) AS n FROM l""",
)
def parse_set(spark, folder):
    answers = table(spark, folder, "part").select("p_partkey", F.expr(LIST_TEXT).alias("answer"))
    items = answers.select("p_partkey", parse.parse_set(F.col("answer")).alias("l"))
    return items.select(
        "p_partkey", F.array_join(F.array_sort("l"), "|").alias("items"), F.size("l").cast("bigint").alias("n")
    )


# The same lists read as Python literals: the exact mode agrees wherever JSON can say it.
@query(
    "parse_list_exact",
    f"""
    WITH {_LIST_SQL}
    SELECT p_partkey, coalesce(array_to_string(items, '|'), trim(answer, ' ' || chr(10))) AS items,
           coalesce(len(items), 1) AS n FROM l""",
)
def parse_list_exact(spark, folder):
    answers = table(spark, folder, "part").select("p_partkey", F.expr(LIST_TEXT).alias("answer"))
    items = answers.select("p_partkey", parse.parse_list(F.col("answer"), exact=True).alias("l"))
    return items.select("p_partkey", F.array_join("l", "|").alias("items"), F.size("l").cast("bigint").alias("n"))


TIMELINE_TEXT = """CASE event_id % 5
    WHEN 0 THEN 'Sure: {"instruments": [{"name": "' || event_type || '", "layer": "foreground", "timestamps": [{"start": "0:' || CAST(10 + event_id % 50 AS VARCHAR(20)) || '", "end": "' || CAST(1 + event_id % 9 AS VARCHAR(20)) || ':05"}, {"start": "3:00"}]}]}'
    WHEN 1 THEN '{"instruments": [{"layer": "background", "timestamps": []}, {"name": "pad", "timestamps": [{"start": "1:00", "end": "end"}]}]}'
    WHEN 2 THEN 'no timeline for ' || event_type
    WHEN 3 THEN '{"instruments": []}'
    ELSE '{"instruments": [{"name": "cut"}' END"""


def _clock(x: str) -> str:
    return f"TRY_CAST(split_part({x}, ':', 1) AS BIGINT) * 60 + TRY_CAST(split_part({x}, ':', 2) AS BIGINT)"


@query(
    "timeline_explode",
    f"""
    WITH t AS (SELECT event_id, regexp_extract({TIMELINE_TEXT}, '(?s)\\{{.*\\}}', 0) AS body FROM events),
    p AS (SELECT event_id, CASE WHEN json_valid(body) THEN from_json(CAST(body AS JSON),
            '{{"instruments":[{{"name":"VARCHAR","layer":"VARCHAR","timestamps":[{{"start":"VARCHAR","end":"VARCHAR"}}]}}]}}') END AS v FROM t),
    i AS (SELECT event_id, coalesce(len(v.instruments), 0) AS n_instruments,
                 unnest(CASE WHEN coalesce(len(v.instruments), 0) = 0 THEN [NULL] ELSE v.instruments END) AS one FROM p),
    s AS (SELECT event_id, n_instruments, one,
                 unnest(CASE WHEN coalesce(len(one.timestamps), 0) = 0 THEN [NULL] ELSE one.timestamps END) AS span FROM i)
    SELECT event_id, CAST(n_instruments AS INTEGER) AS n_instruments,
           CASE WHEN one IS NOT NULL THEN coalesce(one.name, '?') END AS name,
           CASE WHEN one IS NOT NULL THEN coalesce(one.layer, '?') END AS layer,
           CASE WHEN span IS NOT NULL THEN coalesce(span."start", '?') END AS "start",
           CASE WHEN span IS NOT NULL THEN coalesce(span."end", 'end') END AS "end",
           {_clock('span."start"')} AS start_seconds, {_clock('span."end"')} AS end_seconds FROM s""",
)
def timeline_explode(spark, folder):
    answers = table(spark, folder, "events").select("event_id", F.expr(TIMELINE_TEXT).alias("answer"))
    parsed = answers.select("event_id", parse.parse_timeline(F.col("answer")).alias("timeline"))
    return parse.explode_timeline(parsed, "timeline", "event_id")


# Pages get a search-result object in their script; every fourth page has none or a broken one.
_PAGE_TEXT = """html || CASE page_id % 4
    WHEN 3 THEN '<script>var ytInitialData = {"contents": {}};</script>'
    ELSE '<script>var ytInitialData = {"contents":{"twoColumnSearchResultsRenderer":{"primaryContents":{"sectionListRenderer":{"contents":[{"itemSectionRenderer":{"contents":['
      || '{"adRenderer":{"x":1}},'
      || '{"videoRenderer":{"videoId":"v' || CAST(page_id AS VARCHAR(20)) || '","title":{"runs":[{"text":"' || url || '"}]},"ownerText":{"runs":[{"text":"own"}]},"lengthText":{"simpleText":"3:21"}}},'
      || '{"videoRenderer":{"videoId":"","title":{"runs":[{"text":"no id"}]}}},'
      || '{"videoRenderer":{"videoId":"w' || CAST(page_id AS VARCHAR(20)) || '"}},'
      || '{"videoRenderer":{"videoId":"x' || CAST(page_id AS VARCHAR(20)) || '","title":{"runs":[{"text":"third"}]}}}'
      || ']}}]}}}}};</script>' END"""


@query(
    "embedded_json",
    f"""
    WITH p AS (SELECT page_id, regexp_extract({_PAGE_TEXT}, 'var ytInitialData = (\\{{.*?\\}});', 1) AS body FROM pages),
    items AS (
        SELECT page_id, unnest(CAST(json_extract(body,
            '$.contents.twoColumnSearchResultsRenderer.primaryContents.sectionListRenderer.contents[0].itemSectionRenderer.contents') AS JSON[])) AS item,
            generate_subscripts(CAST(json_extract(body,
            '$.contents.twoColumnSearchResultsRenderer.primaryContents.sectionListRenderer.contents[0].itemSectionRenderer.contents') AS JSON[]), 1) AS pos
        FROM p),
    vids AS (
        SELECT page_id, json_extract_string(item, '$.videoRenderer.videoId') AS video_id,
               coalesce(json_extract_string(item, '$.videoRenderer.title.runs[0].text'), '') AS title,
               coalesce(json_extract_string(item, '$.videoRenderer.ownerText.runs[0].text'), '') AS channel,
               coalesce(json_extract_string(item, '$.videoRenderer.lengthText.simpleText'), '') AS duration, pos FROM items),
    kept AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn FROM vids WHERE coalesce(video_id, '') <> '')
    SELECT page_id, title, video_id, 'https://www.youtube.com/watch?v=' || video_id AS url, channel, duration
    FROM kept WHERE rn <= 2""",
)
def embedded_json(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", F.expr(_PAGE_TEXT).alias("page"))
    return pages.select("page_id", F.inline(parse.embedded_videos(F.col("page"), 2)))


SYSTEM = "You label sounds."
STEP_1 = "Describe {every} layer."
STEP_2 = 'Based on:\n\n{step_1}\n\nReturn {{"background": []}} only:'
STEP_3 = 'Layers:\n{step_1}\nTimes:\n{step_2}\nReturn {{"instruments": []}}'


def _chat_rows(df, chat_column, *keep):
    """Chats as flat rows: one per message part."""
    messages = df.select(*keep, F.posexplode(chat_column).alias("message", "m"))
    return messages.select(*keep, "message", "m.role", F.posexplode("m.content").alias("part", "c")).select(
        *keep, "message", "role", "part", "c.type", "c.text", F.octet_length("c.audio").alias("audio_bytes")
    )


@query(
    "build_chat",
    """
    SELECT conv_id, turn, CAST(0 AS INTEGER) AS message, 'system' AS role, CAST(0 AS INTEGER) AS part, 'text' AS type,
           'You label sounds.' || chr(10) || chr(10) || 'Describe {every} layer.' AS text,
           CAST(NULL AS INTEGER) AS audio_bytes FROM conversations
    UNION ALL SELECT conv_id, turn, 1, 'user', 0, 'audio', NULL, CAST(octet_length(encode(text)) AS INTEGER)
        FROM conversations WHERE role <> 'system'
    UNION ALL SELECT conv_id, turn, 1, 'user', CASE WHEN role <> 'system' THEN 1 ELSE 0 END, 'text', text, NULL
        FROM conversations WHERE role <> 'assistant'""",
)
def build_chat(spark, folder):
    # the turn's bytes stand in for audio; parts are absent for some roles
    audio = F.when(F.col("role") != "system", F.encode("text", "UTF-8"))
    text = F.when(F.col("role") != "assistant", F.col("text"))
    turns = table(spark, folder, "conversations").select(
        "conv_id", "turn", chat.first_step_chat(SYSTEM, STEP_1, audio, text).alias("chat")
    )
    return _chat_rows(turns, "chat", "conv_id", "turn")


@query(
    "build_chat_step2",
    """
    SELECT conv_id, turn, 2 AS step,
           'Describe {every} layer.' || chr(10) || chr(10) || 'Based on:' || chr(10) || chr(10) || text || ' {step_2} {{x}}'
           || chr(10) || chr(10) || 'Return {"background": []} only:' AS prompt FROM conversations
    UNION ALL
    SELECT conv_id, turn, 3, 'Layers:' || chr(10) || text || ' {step_2} {{x}}' || chr(10) || 'Times:' || chr(10)
           || role || chr(10) || 'Return {"instruments": []}' FROM conversations""",
)
def build_chat_step2(spark, folder):
    # braces inside the inserted answers must stay as they are
    first = F.concat("text", F.lit(" {step_2} {{x}}"))
    audio = F.lit(None).cast("binary")
    turns = table(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        F.array(
            F.struct(F.lit(2).alias("step"), chat.next_step_chat(SYSTEM, STEP_2, audio, STEP_1, step_1=first).alias("chat")),
            F.struct(
                F.lit(3).alias("step"),
                chat.next_step_chat(SYSTEM, STEP_3, audio, step_1=first, step_2=F.col("role")).alias("chat"),
            ),
        ).alias("steps"),
    )
    steps = turns.select("conv_id", "turn", F.inline("steps"))
    user = F.get(F.get("chat", F.lit(1))["content"], F.lit(0))
    return steps.select("conv_id", "turn", "step", user["text"].alias("prompt"))
