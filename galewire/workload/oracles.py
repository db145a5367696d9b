"""The same questions as DuckDB SQL over the benchmark tables.

``CTES`` holds named building blocks; ``_q`` puts those a query mentions in front of it.
"""

import re


WS = r"[\s\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

# The engine's fixed numbers and word lists, once more.
FLOOR = -12000
NEGATIONS = """not no never none nobody nothing neither nor nowhere cannot without hardly rarely seldom
    barely""".split()
BOOSTERS = dict.fromkeys("""absolutely amazingly awfully completely considerably deeply enormously entirely
    especially exceptionally extremely fully greatly highly hugely incredibly intensely more most particularly
    purely quite really remarkably so substantially thoroughly totally tremendously unbelievably unusually
    utterly very""".split(), 1) | dict.fromkeys("""almost kinda less little marginally occasionally partly
    scarcely slightly somewhat sorta""".split(), -1)
TEXT_LEXICON = {
    "amazing": 2.8, "awful": -2.0, "bad": -2.5, "beautiful": 2.9, "best": 3.2, "better": 1.9,
    "calm": 1.3, "catastrophe": -3.4, "clean": 1.7, "crisis": -3.1, "damage": -2.2,
    "damaged": -1.9, "danger": -2.4, "dangerous": -2.1, "dead": -3.3, "destroyed": -2.2,
    "devastating": -2.3, "disaster": -3.1, "enjoy": 2.2, "evacuate": -1.3, "excellent": 2.7,
    "fear": -2.2, "fine": 0.8, "flood": -1.2, "fun": 2.3, "glad": 2.0, "good": 1.9,
    "great": 3.1, "happy": 2.7, "hate": -2.7, "healing": 1.7, "help": 1.7, "hope": 1.9,
    "horrible": -2.5, "hurt": -2.4, "injured": -1.7, "kill": -3.7, "killed": -3.5, "lost": -1.3,
    "love": 3.2, "miss": -0.6, "nice": 1.8, "panic": -2.3, "perfect": 2.7, "rescue": 2.3,
    "sad": -2.1, "safe": 1.9, "scary": -2.2, "severe": -1.6, "storm": -0.9, "sunny": 1.7,
    "terrible": -2.1, "thank": 1.5, "thanks": 1.9, "threat": -2.4, "tragic": -2.0, "warning": -1.4,
    "wonderful": 2.7, "worry": -1.9, "worse": -2.1, "worst": -3.1,
    "and": 0.4, "the": -0.3, "that": 0.7, "of": -0.6, "le": 0.5, "de": -0.4, "que": 0.6,
    "und": -0.5, "der": 0.3, "la": 0.2, "el": -0.7, "not": -0.2,
}

# What the posts hold, spelled out here so that the engine's own tables are not asked.
EMOJI = {
    "😢": ("crying_face", -0.8), "🌞": ("sun_with_face", 0.7), "❤": ("red_heart", 0.9),
    "💪": ("flexed_biceps", 0.0),
}
SELECTOR = "\ufe0f"
SHORT_FORMS = {
    "Don't": "Do not", "we'll": "we will", "it's": "it is", "can't": "cannot",
    "y’all": "you all", "wouldn't've": "would not have", "o'clock": "of the clock",
    "ma'am": "madam", "gonna": "going to",
}
COMPATIBLE = {"ﬁ": "fi", "½": "1⁄2"}


def s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def r(x: str, digits: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def pytrim(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def text_hash(x: str) -> str:
    return f"md5(lower({pytrim(x)}))"


def normalize_ws(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def strip_urls(x: str) -> str:
    return rf"regexp_replace({x}, '(https?://|www\.)\S+', '', 'g')"


def contractions(x: str) -> str:
    for short, full in SHORT_FORMS.items():
        x = f"replace({x}, {s(short)}, {s(full)})"
    return x


def camel(x: str) -> str:
    x = rf"regexp_replace({x}, '([a-z])([A-Z])', '\1 \2', 'g')"
    return rf"lower(regexp_replace({x}, '([a-zA-Z])(\d)', '\1 \2', 'g'))"


def emoji_spelled(x: str) -> str:
    for e, (name, _) in EMOJI.items():
        x = f"replace(replace({x}, {s(e + SELECTOR)}, {s(e)}), {s(e)}, {s(f' :{name}: ')})"
    return x


def _scores(negations: list[str], boosters: dict[str, int], turns: list[str]) -> str:
    """Score of each cleaned text by the lexicon, in whole units of 10^-8."""
    names = lambda ws: ", ".join(s(w) for w in ws)
    boost = " + ".join(
        f"coalesce(CASE WHEN i > {n} THEN CASE w[i - {n}] "
        + " ".join(f"WHEN {s(w)} THEN {x * size}" for w, x in boosters.items()) + " END END, 0)"
        for n, size in ((1, 29300), (2, 27835), (3, 26370))
    )
    upper = "(upper({0}) = {0} AND lower({0}) <> {0})".format
    return f"""
        SELECT c.id AS tweet_id, {r('v / sqrt(v * v + 15)', 4)} AS raw_score
        FROM (SELECT id, (total + sign(total) * (least(bangs, 4) * 29200000 + CASE WHEN asks < 2 THEN 0
                    WHEN asks < 4 THEN asks * 18000000 ELSE 96000000 END)) / 100000000.0::DOUBLE AS v
              FROM (SELECT c.id, coalesce(total, 0) AS total,
                        len(c.text_clean) - len(replace(c.text_clean, '!', '')) AS bangs,
                        len(c.text_clean) - len(replace(c.text_clean, '?', '')) AS asks
                    FROM cleaned c LEFT JOIN (
                        SELECT id, CAST(sum((x + sign(x) * (boost + CASE WHEN {upper('o[i]')}
                                AND len(list_filter(o, lambda q: NOT {upper('q')})) > 0 THEN 73300 ELSE 0 END))
                            * CASE WHEN i > 1 AND list_has_any(list_slice(w, greatest(i - 3, 1), i - 1), [{names(negations)}])
                                THEN -74 ELSE 100 END
                            * CASE WHEN turn IS NULL OR i = turn THEN 10 WHEN i < turn THEN 5 ELSE 15 END) AS BIGINT) AS total
                        FROM (SELECT *, CAST(round(l.weight * 1000) AS BIGINT) * 100 AS x, {boost} AS boost,
                                list_min(list_filter(range(1, len(w) + 1), lambda k: list_contains([{names(turns)}], w[k]))) AS turn
                              FROM words JOIN lexicon l ON l.token = w[i]) GROUP BY id) USING (id))) JOIN cleaned c USING (id)"""


def chars(x: str) -> str:
    return f"regexp_extract_all({x}, '(?s).')"


def emoji_list(x: str) -> str:
    return f"regexp_extract_all({x}, '[{''.join(EMOJI)}]')"


def emoji_score(x: str) -> str:
    cases = " ".join(f"WHEN {s(e)} THEN {w}" for e, (_, w) in EMOJI.items())
    return (
        f"CAST(coalesce(list_sum(list_transform({x}, lambda e: "
        f"CASE e {cases} ELSE 0.0 END)), 0) AS DOUBLE)"
    )


def compatible(x: str) -> str:
    for char, plain in COMPATIBLE.items():
        x = f"replace({x}, {s(char)}, {s(plain)})"
    return x


def hashtags_spelled(x: str) -> str:
    for tag, words in (("ClimateChange", "climate change"), ("Flood2024", "flood 2024")):
        x = f"CASE WHEN list_contains(hashtags, '{tag}') THEN replace({x}, '#{tag}', '{words}') ELSE {x} END"
    return x


def timestamp(x: str) -> str:
    iso = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
    return (
        f"CASE WHEN regexp_matches({x}, '{iso}') THEN "
        f"CAST(CAST(CASE WHEN regexp_matches({x}, '(Z|[+-][0-9][0-9]:?[0-9][0-9])$') "
        f"AND length({x}) > 10 THEN {x} ELSE {x} || '+00' END AS TIMESTAMPTZ) "
        f"AT TIME ZONE 'UTC' AS TIMESTAMP) END"
    )


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(2 * 6371.0::DOUBLE * atan2(sqrt({a}), sqrt(1 - {a})))"


def event(precip: str, wind: str, tmax: str) -> str:
    return f"""CASE WHEN coalesce({precip}, 0) > 25 THEN 'heavy_rain'
        WHEN coalesce({precip}, 0) > 10 THEN 'rain' WHEN coalesce({precip}, 0) > 0 THEN 'light_rain'
        WHEN coalesce({wind}, 0) > 20 THEN 'high_wind' WHEN coalesce({wind}, 0) > 10 THEN 'windy'
        WHEN {tmax} > 35 THEN 'extreme_heat' WHEN {tmax} > 30 THEN 'heat'
        WHEN {tmax} < 0 THEN 'freezing' WHEN {tmax} < 5 THEN 'cold' ELSE 'normal' END"""


def _time(k: str) -> str:
    return f"(TIMESTAMP '2024-01-01' + to_minutes(CAST({k} * 37 % 43200 AS INTEGER)))"


def _values(table: dict) -> str:
    return ", ".join(f"({s(k)}, {v})" for k, v in table.items())


TEXT = """concat(
    CASE WHEN doc_id % 13 = 0 THEN 'RT @u: ' ELSE '' END, text,
    CASE WHEN doc_id % 4 = 1 THEN ' @user1' ELSE '' END,
    CASE WHEN doc_id % 5 = 0 THEN ' #ClimateChange' ELSE '' END,
    CASE WHEN doc_id % 6 = 0 THEN ' #Flood2024' ELSE '' END,
    CASE WHEN doc_id % 7 = 0 THEN ' https://ex.org/' || doc_id ELSE '' END,
    CASE WHEN doc_id % 9 = 0 THEN ' Don''t worry, we''ll see it''s fine, I can''t complain' ELSE '' END,
    CASE WHEN doc_id % 11 = 0 THEN ' 😢' ELSE '' END,
    CASE WHEN doc_id % 17 = 0 THEN ' 🌞❤️' ELSE '' END,
    CASE WHEN doc_id % 10 = 3 THEN '  ' || chr(9) || ' storm   warning' || chr(10) || ' ' ELSE '' END,
    CASE WHEN doc_id % 14 = 1 THEN ' flood' ELSE '' END,
    CASE WHEN doc_id % 19 = 2 THEN ' strong 💪💪 day 🥆🔾 ﬁne ½' ELSE '' END,
    CASE WHEN doc_id % 23 = 5 THEN
        ' y’all wouldn''t''ve gone at six o''clock, ma''am, gonna be VERY good!!' ELSE '' END)"""


def _stamp(ts: str) -> str:
    return f"""CASE lang WHEN 'en' THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S.%gZ')
        WHEN 'fr' THEN strftime({ts} + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || '+02:00'
        WHEN 'de' THEN strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')
        ELSE strftime({ts}, '%Y-%m-%d %H:%M:%S') END"""


LAT = "(25.0::DOUBLE + doc_id % 10 * 2 + (doc_id % 7 - 3) * 0.2::DOUBLE)"
LON = "(-120.0::DOUBLE + (doc_id // 10) % 10 * 5 + (doc_id % 3 - 1) * 0.1::DOUBLE)"

CTES = {
    "posts": f"""
        SELECT doc_id AS k, CAST(doc_id AS VARCHAR) AS id, {TEXT} AS text,
            {_time('doc_id')} AS ts, {_stamp(_time('doc_id'))} AS created_at,
            'u' || (doc_id * 3 % 4000) AS author_id, lang,
            CASE WHEN doc_id % 4 = 2 THEN '  Nation_' || (doc_id % 25) || ' ' END AS user_location,
            CASE WHEN doc_id % 4 = 0 THEN {LAT} END AS pt_lat,
            CASE WHEN doc_id % 4 = 0 THEN {LON} END AS pt_lon,
            CASE WHEN doc_id % 4 = 1 THEN 'pl' || (doc_id % 25) END AS place_id,
            list_concat(CASE WHEN doc_id % 5 = 0 THEN ['ClimateChange'] ELSE CAST([] AS VARCHAR[]) END,
                CASE WHEN doc_id % 6 = 0 THEN ['Flood2024'] ELSE CAST([] AS VARCHAR[]) END) AS hashtags,
            CASE WHEN doc_id % 4 = 1 THEN ['user1'] ELSE CAST([] AS VARCHAR[]) END AS mentions,
            CASE WHEN doc_id % 7 = 0 THEN ['https://ex.org/' || doc_id]
                ELSE CAST([] AS VARCHAR[]) END AS urls,
            CAST(doc_id % 50 AS INTEGER) AS retweet_count,
            doc_id % 13 = 0 AS repost
        FROM documents""",
    "places": """
        SELECT 'pl' || n_nationkey AS place_id, n_name AS full_name, n_nationkey % 2 = 0 AS boxed,
            lat - 0.05::DOUBLE AS lat0, lat + 0.05::DOUBLE AS lat1,
            lon - 0.05::DOUBLE AS lon0, lon + 0.05::DOUBLE AS lon1
        FROM (SELECT *, 25.0::DOUBLE + n_nationkey % 10 * 2 + 0.1::DOUBLE AS lat,
            -120.0::DOUBLE + (n_nationkey // 10) % 10 * 5 + 0.1::DOUBLE AS lon FROM nation)""",
    "centres": """
        SELECT place_id, full_name,
            CASE WHEN boxed THEN (lat0 + lat1) / 2
                ELSE (((lat0 + lat0) + lat1) + lat1) / 4 END AS lat,
            CASE WHEN boxed THEN (lon0 + lon1) / 2
                ELSE (((lon0 + lon1) + lon1) + lon0) / 4 END AS lon
        FROM places""",
    "users": """
        SELECT 'u' || c_custkey AS author_id,
            CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'NATION_' || c_nationkey END AS location
        FROM customer""",
    "gazetteer": """
        SELECT lower(n_name) AS location_key,
            25.0::DOUBLE + n_nationkey % 10 * 2 + 0.05::DOUBLE AS lat,
            -120.0::DOUBLE + (n_nationkey // 10) % 10 * 5 + 0.02::DOUBLE AS lon FROM nation""",
    "stations": """
        SELECT 'ST' || s_suppkey AS id, s_name AS name,
            25.0::DOUBLE + s_suppkey % 10 * 2 + (s_suppkey // 100) * 0.05::DOUBLE AS latitude,
            -120.0::DOUBLE + (s_suppkey // 10) % 10 * 5 AS longitude, s_acctbal AS elevation
        FROM supplier""",
    "observations": """
        SELECT 'ST' || (user_id % 100) AS station_id, ts AS obs_at,
            CASE event_type WHEN 'click' THEN 'TMAX' WHEN 'view' THEN 'TMIN'
                WHEN 'purchase' THEN 'PRCP' WHEN 'error' THEN 'AWND' ELSE 'SNOW' END AS datatype,
            CASE WHEN event_type = 'click' THEN round(value * 4 - 100, 2) ELSE value END AS value
        FROM events""",
    "located_raw": """
        SELECT p.* EXCLUDE (user_location), c.full_name, c.lat AS c_lat, c.lon AS c_lon,
            CASE WHEN u.author_id IS NOT NULL THEN u.location ELSE p.user_location END AS user_location
        FROM posts p LEFT JOIN centres c USING (place_id) LEFT JOIN users u USING (author_id)""",
    "geo": f"""
        SELECT l.id AS tweet_id, l.ts AS created_at,
            coalesce(pt_lat, c_lat, g.lat) AS geo_lat, coalesce(pt_lon, c_lon, g.lon) AS geo_lon,
            CASE WHEN pt_lat IS NOT NULL THEN 'high' WHEN c_lat IS NOT NULL THEN 'medium'
                WHEN g.lat IS NOT NULL THEN 'low' ELSE 'unavailable' END AS geo_confidence,
            CASE WHEN pt_lat IS NOT NULL THEN 'coordinates' WHEN c_lat IS NOT NULL THEN 'place_centroid'
                WHEN g.lat IS NOT NULL THEN 'user_location_geocoded' ELSE 'unavailable' END AS geo_source,
            CASE WHEN pt_lat IS NULL AND c_lat IS NOT NULL THEN full_name END AS place_name,
            CASE WHEN pt_lat IS NULL AND c_lat IS NULL AND g.lat IS NOT NULL
                THEN user_location END AS user_location_string
        FROM located_raw l LEFT JOIN gazetteer g ON lower({pytrim('l.user_location')}) = g.location_key""",
    "nearest": f"""
        SELECT lat, lon, arg_min(struct_pack(id := id, name := name, d := d, la := latitude,
            lo := longitude, el := elevation), struct_pack(d := d, n := name, i := id)) AS st
        FROM (SELECT p.lat, p.lon, t.*, {haversine('p.lat', 'p.lon', 't.latitude', 't.longitude')} AS d
              FROM (SELECT DISTINCT geo_lat AS lat, geo_lon AS lon FROM geo WHERE geo_lat IS NOT NULL) p,
                   stations t)
        WHERE d <= 50 GROUP BY lat, lon""",
    "stationed": f"""
        SELECT g.*, n.st.id AS station_id, n.st.name AS station_name, {r('n.st.d', 2)} AS distance_km
        FROM geo g LEFT JOIN nearest n ON g.geo_lat = n.lat AND g.geo_lon = n.lon""",
    "windowed": """
        SELECT s.tweet_id, s.created_at, s.station_id, s.distance_km, o.obs_at, o.datatype,
            CAST(o.value AS DECIMAL(18,6)) AS value,
            abs(epoch_us(o.obs_at) - epoch_us(s.created_at)) AS diff
        FROM stationed s JOIN observations o ON o.station_id = s.station_id
            AND CAST(o.obs_at AS DATE) BETWEEN CAST(s.created_at - INTERVAL 1 HOUR AS DATE)
                AND CAST(s.created_at + INTERVAL 1 HOUR AS DATE)
        WHERE o.value IS NOT NULL""",
    "rollup": f"""
        SELECT tweet_id, count(*) AS n_obs, {r('tmax / 10', 1)} AS weather_temp_max_c,
            {r('tmin / 10', 1)} AS weather_temp_min_c,
            {r('(tmax / 10 + tmin / 10) / 2', 1)} AS weather_temp_c,
            {r('prcp / 10', 1)} AS weather_precip_mm, {r('wind / 10', 1)} AS weather_wind_speed_ms,
            any_value(best.obs_at) AS closest_at, any_value(best.diff) AS diff
        FROM (SELECT tweet_id, count(*) AS c,
                CAST(max(value) FILTER (datatype = 'TMAX') AS DOUBLE) AS tmax,
                CAST(min(value) FILTER (datatype = 'TMIN') AS DOUBLE) AS tmin,
                CAST(sum(value) FILTER (datatype = 'PRCP') AS DOUBLE) AS prcp,
                CAST(sum(value) FILTER (datatype = 'AWND') AS DOUBLE)
                    / nullif(count(*) FILTER (datatype = 'AWND'), 0) AS wind,
                arg_min(struct_pack(obs_at := obs_at, diff := diff), struct_pack(d := diff, a := obs_at)) AS best
              FROM windowed GROUP BY tweet_id)
        GROUP BY tweet_id, tmax, tmin, prcp, wind""",
    "weather": f"""
        SELECT s.tweet_id, s.station_id AS weather_station_id, s.station_name AS weather_station_name,
            s.distance_km AS weather_station_distance_km, weather_temp_c, weather_temp_max_c,
            weather_temp_min_c, weather_precip_mm, weather_wind_speed_ms,
            CASE WHEN o.tweet_id IS NOT NULL THEN
                {event('weather_precip_mm', 'weather_wind_speed_ms', 'weather_temp_max_c')}
                END AS weather_event_type,
            strftime(closest_at, '%Y-%m-%dT%H:%M:%S') AS weather_observation_time,
            CASE WHEN s.station_id IS NULL THEN 'no_geolocation'
                WHEN o.tweet_id IS NULL THEN 'no_observations'
                WHEN s.distance_km < 10 AND diff < 1800000000 THEN 'high'
                WHEN s.distance_km < 30 AND diff < 3600000000 THEN 'medium' ELSE 'low'
                END AS noaa_match_quality,
            CASE WHEN s.geo_lat IS NULL THEN 'no_geo' WHEN s.station_id IS NULL THEN 'no_station'
                WHEN o.tweet_id IS NULL THEN 'no_observations' ELSE 'enriched' END AS weather_outcome
        FROM stationed s LEFT JOIN rollup o USING (tweet_id)""",
    "normal": f"""
        SELECT *, {compatible('nfc_normalize(text)')} AS t0 FROM posts""",
    "cleaned": f"""
        SELECT *, length(text_clean) AS text_length,
            CASE WHEN text_clean = '' THEN 0 ELSE len(string_split(text_clean, ' ')) END AS word_count,
            len(emojis) AS emoji_count, {emoji_score('emojis')} AS emoji_sentiment_score,
            len(urls) > 0 AS has_media
        FROM (SELECT *, {emoji_list('t0')} AS emojis,
                {normalize_ws(contractions(strip_urls('t2')))} AS text_clean
              FROM (SELECT *, {hashtags_spelled('t1')} AS t2
                    FROM (SELECT *, {emoji_spelled('t0')} AS t1 FROM normal)))""",
    "arrivals": f"""
        SELECT CAST(k AS VARCHAR) AS tweet_id, created_at, k % 13 = 0 AS retweet_status,
            CASE WHEN k % 13 = 0 THEN 'RT @u: ' ELSE '' END || text AS text,
            {text_hash("CASE WHEN k % 13 = 0 THEN 'RT @u: ' ELSE '' END || text")} AS h
        FROM (SELECT doc_id AS k, {_time('doc_id')} AS created_at, text FROM documents
              UNION ALL SELECT conv_id, {_time('(conv_id * 7 + turn * 11)')}, text FROM conversations
              UNION ALL SELECT doc_id, {_time('doc_id')}, text FROM documents
                        WHERE doc_id IN (SELECT page_id FROM pages))""",
    "messy": """
        SELECT p.id AS doc_key, CASE WHEN d.source <> 'src0' THEN p.id END AS tweet_id,
            CASE WHEN d.source = 'src1' THEN ' ' || chr(9) || '  '
                WHEN coalesce(l.toxic, 0) = 0 THEN p.text END AS text,
            CASE WHEN d.source = 'src2' THEN 'yesterday'
                WHEN d.source <> 'src3' THEN p.created_at END AS created_at
        FROM posts p JOIN documents d ON d.doc_id = p.k LEFT JOIN labels l ON l.doc_id = p.k""",
    "reasons": f"""
        SELECT *, CASE WHEN tweet_id IS NULL THEN 'missing_tweet_id' WHEN text IS NULL THEN 'missing_text'
            WHEN created_at IS NULL THEN 'missing_created_at'
            WHEN {pytrim('text')} = '' THEN 'blank_text'
            WHEN created_at = 'yesterday' THEN 'bad_timestamp' END AS reject_reason FROM messy""",
    "faults": """
        SELECT k, k % 29 AS fault, CASE WHEN k % 29 <> 1 THEN id END AS tweet_id,
            CASE k % 29 WHEN 1 THEN 'missing_tweet_id' WHEN 2 THEN 'missing_text'
                WHEN 3 THEN 'missing_created_at' WHEN 4 THEN 'blank_text' WHEN 5 THEN 'bad_timestamp'
                ELSE 'corrupt_record' END AS reject_reason
        FROM posts WHERE k % 29 BETWEEN 1 AND 6""",
    "grams": f"""
        SELECT lang, c[i] || c[i + 1] || c[i + 2] AS gram FROM (
            SELECT lang, c, unnest(range(1, len(c) - 1)) AS i
            FROM (SELECT lang, {chars('lower(text)')} AS c FROM documents))""",
    "gram_counts": "SELECT lang, gram, count(*) AS n FROM grams GROUP BY lang, gram",
    "profiles": f"""
        SELECT lang, gram, CAST(round(ln(n / total) * 1000) AS BIGINT) + {-FLOOR} AS weight
        FROM (SELECT *, sum(n) OVER (PARTITION BY lang) AS total FROM gram_counts)""",
    "post_grams": f"""
        SELECT id, c[i] || c[i + 1] || c[i + 2] AS gram FROM (
            SELECT id, c, unnest(range(1, len(c) - 1)) AS i
            FROM (SELECT id, {chars('lower(text_clean)')} AS c FROM cleaned))""",
    "lang_scores": """
        SELECT id, p.lang, CAST(sum(weight) AS BIGINT) AS score
        FROM post_grams JOIN profiles p USING (gram) GROUP BY id, p.lang""",
    "detected": f"""
        SELECT id AS tweet_id, arg_max(lang, struct_pack(s := score, l := lang)) AS det_lang,
            {r('1 / sum(exp((score - top) / 1000.0::DOUBLE))', 3)} AS det_conf
        FROM (SELECT *, max(score) OVER (PARTITION BY id) AS top FROM lang_scores) GROUP BY id""",
    "lang_tags": f"""
        SELECT c.id AS tweet_id,
            CASE WHEN length(c.text_clean) < 10 THEN c.lang WHEN det_conf >= 0.5 THEN det_lang
                ELSE c.lang END AS detected_lang,
            CASE WHEN length(c.text_clean) < 10 THEN 0.5::DOUBLE WHEN det_conf >= 0.5 THEN det_conf
                ELSE 0.3::DOUBLE END AS lang_confidence,
            CASE WHEN length(c.text_clean) < 10 THEN 'twitter_short_text'
                WHEN det_conf >= 0.5 THEN 'ngram_profile' ELSE 'twitter_fallback' END AS lang_method
        FROM cleaned c LEFT JOIN detected d ON d.tweet_id = c.id""",
    "lexicon": f"SELECT * FROM (VALUES {_values(TEXT_LEXICON)}) v(token, weight)",
    "words": r"""
        SELECT id, t, list_transform(w, lambda x: lower(x)) AS w, w AS o, unnest(range(1, len(w) + 1)) AS i FROM (
            SELECT id, text_clean AS t, list_filter(string_split_regex(text_clean, '[^\p{L}\p{N}_]+'),
                lambda x: x <> '') AS w FROM cleaned)""",
    "lexicon_scores": _scores(NEGATIONS, BOOSTERS, ["but"]),
    "lexicon_scores_by_rules": _scores(
        ["not", "no", "without", "by", "pour", "con"],
        {"very": 1, "a": 1, "is": -1, "les": 1, "los": -1, "die": 1, "was": 1},
        ["but", "this", "des", "por", "mit"]),
    "sentiments": f"""
        SELECT tweet_id, {r('score', 3)} AS sentiment_score,
            CASE WHEN score > 0.3 THEN 'positive' WHEN score < -0.3 THEN 'negative' ELSE 'neutral' END
                AS sentiment_label,
            {r('abs(raw_score)', 3)} AS sentiment_confidence
        FROM (SELECT l.*, greatest(-1.0, least(1.0, raw_score + greatest(-0.2::DOUBLE,
                least(0.2::DOUBLE, c.emoji_sentiment_score * 0.2::DOUBLE)))) AS score
              FROM lexicon_scores l JOIN cleaned c ON c.id = l.tweet_id)""",
    "processed": f"""
        SELECT CAST(doc_id AS VARCHAR) AS tweet_id, source AS author_id, {_time('doc_id')} AS created_at,
            lang AS detected_lang, text AS text_clean, CAST(length(text) AS INTEGER) AS text_length,
            CASE WHEN doc_id % 3 = 0 THEN 'twitter_fallback' ELSE 'ngram_profile' END AS lang_method,
            CAST(doc_id % 3 AS INTEGER) AS hashtag_count, CAST(doc_id % 2 AS INTEGER) AS mention_count,
            CAST(doc_id % 5 AS INTEGER) AS emoji_count,
            (doc_id * 3 % 21 - 10) / 10.0::DOUBLE AS emoji_sentiment_score,
            CASE WHEN doc_id % 4 <> 3 THEN 25.0::DOUBLE + doc_id % 10 END AS geo_lat,
            CASE WHEN doc_id % 4 <> 3 THEN -120.0::DOUBLE + doc_id % 7 END AS geo_lon,
            CASE doc_id % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low'
                ELSE 'unavailable' END AS geo_confidence,
            CASE doc_id % 4 WHEN 0 THEN 'coordinates' WHEN 1 THEN 'place_centroid'
                WHEN 2 THEN 'user_location_geocoded' ELSE 'unavailable' END AS geo_source,
            CASE WHEN doc_id % 4 = 1 THEN 'PLACE_' || (doc_id % 3) END AS place_name,
            CASE WHEN doc_id % 9 <> 0 THEN 'ST' || (doc_id % 100) END AS weather_station_id,
            CASE WHEN doc_id % 9 <> 0 THEN 'Station ' || (doc_id % 100) END AS weather_station_name,
            CASE WHEN doc_id % 9 <> 0 THEN (doc_id * 7 % 500) / 10.0::DOUBLE END
                AS weather_station_distance_km,
            temp AS weather_temp_c, precip AS weather_precip_mm, wind AS weather_wind_speed_ms,
            CASE WHEN doc_id % 8 <> 0 THEN {event('precip', 'wind', '(temp + 3)')} END AS weather_event_type,
            CASE doc_id % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low'
                WHEN 3 THEN 'no_observations' END AS noaa_match_quality,
            score AS sentiment_score,
            CASE WHEN score > 0.3 THEN 'positive' WHEN score < -0.3 THEN 'negative' ELSE 'neutral' END
                AS sentiment_label,
            CASE WHEN lang = 'en' THEN 'lexicon_en' ELSE 'lexicon_multi' END AS sentiment_method,
            (doc_id * 29 % 1001) / 1000.0::DOUBLE AS sentiment_confidence,
            strftime({_time('doc_id')}, '%Y-%m-%d') AS processing_date
        FROM (SELECT *, (doc_id * 17 % 2001 - 1000) / 1000.0::DOUBLE AS score,
                (doc_id * 7 % 550 - 100) / 10.0::DOUBLE AS temp,
                CASE WHEN doc_id % 17 <> 0 THEN CASE WHEN doc_id % 3 = 0
                    THEN (doc_id * 13 % 400) / 10.0::DOUBLE ELSE 0.0::DOUBLE END END AS precip,
                (doc_id * 11 % 250) / 10.0::DOUBLE AS wind
              FROM documents)""",
    "analytics": """
        SELECT tweet_id, created_at, author_id, detected_lang, text_clean, sentiment_score,
            sentiment_label, sentiment_method, sentiment_confidence, geo_lat, geo_lon,
            geo_confidence, geo_source, place_name, weather_station_id, weather_station_name,
            weather_station_distance_km, weather_temp_c, weather_precip_mm, weather_wind_speed_ms,
            weather_event_type, noaa_match_quality, hashtag_count, mention_count, emoji_count,
            emoji_sentiment_score, processing_date
        FROM processed
        WHERE geo_confidence IN ('high', 'medium') AND weather_station_id IS NOT NULL
            AND sentiment_confidence > 0.5 AND text_length > 10""",
    "survivors": f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY {text_hash('text')} ORDER BY ts, id) AS rn
            FROM posts WHERE NOT repost) WHERE rn = 1""",
    "first_ids": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tweet_id ORDER BY created_at, h) AS rid
            FROM arrivals WHERE NOT retweet_status) WHERE rid = 1""",
    "chain": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY created_at, tweet_id) AS rtx
            FROM first_ids) WHERE rtx = 1""",
    "outcomes": """
        SELECT a.tweet_id, a.created_at, a.h AS text_hash, CASE WHEN a.retweet_status THEN 'repost'
            WHEN a.rid > 1 THEN 'dup_id' WHEN c.tweet_id IS NULL THEN 'dup_text' ELSE 'kept' END
            AS dedup_outcome
        FROM (SELECT *, row_number() OVER (PARTITION BY tweet_id, retweet_status
                ORDER BY created_at, h) AS rid FROM arrivals) a
        LEFT JOIN chain c ON c.tweet_id = a.tweet_id AND c.h = a.h AND c.created_at = a.created_at""",
    "enriched": """
        SELECT p.id AS tweet_id, p.author_id, p.ts AS created_at, c.text_clean,
            CAST(c.text_length AS INTEGER) AS text_length, l.detected_lang, l.lang_confidence, l.lang_method, g.geo_lat, g.geo_lon,
            g.geo_confidence, g.place_name, w.* EXCLUDE (tweet_id), t.sentiment_score,
            t.sentiment_label, t.sentiment_confidence,
            CAST(c.emoji_count AS INTEGER) AS emoji_count, c.emoji_sentiment_score,
            CAST(c.word_count AS INTEGER) AS word_count, c.has_media
        FROM survivors p JOIN cleaned c USING (id) JOIN lang_tags l ON l.tweet_id = p.id
            JOIN geo g ON g.tweet_id = p.id JOIN weather w ON w.tweet_id = p.id
            JOIN sentiments t ON t.tweet_id = p.id""",
    "chain_posts": """
        SELECT *, 'lexicon' AS sentiment_method, '2024-01-31' AS processing_date FROM enriched""",
    "chain_analytics": """
        SELECT * FROM chain_posts
        WHERE geo_confidence IN ('high', 'medium') AND weather_station_id IS NOT NULL
            AND sentiment_confidence > 0.5 AND text_length > 10""",
}


def _needed(sql: str, done: list[str]) -> list[str]:
    for name, body in CTES.items():
        if name not in done and re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", sql):
            done = _needed(body, done)
            if name not in done:
                done.append(name)
    return done


def _q(sql: str, *extra: str) -> str:
    """A query with the building blocks it reads, in order of need."""
    ordered = _needed(sql, [])
    blocks = ", ".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in ordered)
    return f"WITH {blocks} {sql}" if blocks else sql


def avg(x: str, digits: int) -> str:
    return r(f"avg({x})", digits)


TREND = """SELECT strftime(created_at, '%Y-%m-%d') AS day, count(*) AS tweet_count, {avg} AS avg_sentiment,
    count(*) FILTER (sentiment_label = 'positive') AS positive_count,
    count(*) FILTER (sentiment_label = 'neutral') AS neutral_count,
    count(*) FILTER (sentiment_label = 'negative') AS negative_count FROM processed GROUP BY day"""


def _shares(column: str, values: list[str], source: str) -> str:
    counts = ", ".join(f"count(*) FILTER ({column} = '{v}') AS {v}_count" for v in values)
    parts = ", ".join(f"{r(f'{v}_count * 100.0 / processed', 1)} AS {v}_pct" for v in values)
    return f"SELECT *, {parts} FROM (SELECT count(*) AS processed, {counts} FROM {source})"


def _kept(source: str) -> str:
    return f"SELECT tweet_id, created_at, h AS text_hash FROM {source}"


REPORTS = {
    "q1_sentiment_distribution": f"""
        SELECT sentiment_label, count(*) AS tweet_count, {avg('sentiment_score', 3)} AS avg_score,
            {avg('sentiment_confidence', 3)} AS avg_confidence FROM analytics GROUP BY ALL""",
    "q2_negative_locations": f"""
        SELECT round(geo_lat, 2) AS lat, round(geo_lon, 2) AS lon, place_name,
            count(*) AS negative_tweet_count, {avg('sentiment_score', 3)} AS avg_sentiment,
            {avg('weather_temp_c', 1)} AS avg_temp_c, {avg('weather_precip_mm', 1)} AS avg_precip_mm,
            {avg('weather_wind_speed_ms', 1)} AS avg_wind_ms, max(weather_event_type) AS primary_event
        FROM analytics WHERE sentiment_label = 'negative'
        GROUP BY round(geo_lat, 2), round(geo_lon, 2), place_name
        ORDER BY negative_tweet_count DESC, lat NULLS LAST, lon NULLS LAST, place_name NULLS LAST
        LIMIT 10""",
    "q3_sentiment_by_event": f"""
        SELECT weather_event_type, count(*) AS tweet_count, {avg('sentiment_score', 3)} AS avg_sentiment,
            {avg('weather_temp_c', 1)} AS avg_temp_c, {avg('weather_precip_mm', 1)} AS avg_precip_mm
        FROM analytics WHERE weather_event_type IS NOT NULL GROUP BY weather_event_type""",
    "q4_daily_trend": f"""
        SELECT processing_date, count(*) AS tweet_count, {avg('sentiment_score', 3)} AS avg_sentiment,
            count(*) FILTER (sentiment_label = 'positive') AS positive_count,
            count(*) FILTER (sentiment_label = 'neutral') AS neutral_count,
            count(*) FILTER (sentiment_label = 'negative') AS negative_count
        FROM analytics GROUP BY processing_date""",
    "q5_language_distribution": f"""
        SELECT detected_lang, sentiment_method, count(*) AS tweet_count,
            {avg('sentiment_score', 3)} AS avg_sentiment
        FROM analytics GROUP BY detected_lang, sentiment_method
        ORDER BY tweet_count DESC, detected_lang, sentiment_method LIMIT 10""",
    "q6_geo_quality": f"""
        SELECT geo_confidence, count(*) AS tweet_count, {avg('sentiment_score', 3)} AS avg_sentiment,
            {avg('weather_station_distance_km', 1)} AS avg_station_distance_km
        FROM processed GROUP BY geo_confidence""",
    "q7_match_quality": f"""
        SELECT noaa_match_quality, count(*) AS tweet_count, {avg('sentiment_score', 3)} AS avg_sentiment
        FROM processed WHERE noaa_match_quality IS NOT NULL GROUP BY noaa_match_quality""",
    "q8_emoji_buckets": f"""
        SELECT CASE WHEN emoji_count = 0 THEN 'no_emoji' WHEN emoji_count <= 2 THEN 'few_emoji'
                ELSE 'many_emoji' END AS emoji_category, count(*) AS tweet_count,
            {avg('sentiment_score', 3)} AS avg_sentiment,
            {avg('emoji_sentiment_score', 3)} AS avg_emoji_sentiment
        FROM analytics GROUP BY 1""",
    "q9_weather_severity": f"""
        SELECT CASE WHEN weather_temp_c > 35 THEN 'extreme_heat' WHEN weather_temp_c > 30 THEN 'hot'
                WHEN weather_temp_c < 0 THEN 'freezing' WHEN weather_temp_c < 10 THEN 'cold'
                ELSE 'moderate' END AS temp_category,
            CASE WHEN weather_precip_mm > 25 THEN 'heavy_rain' WHEN weather_precip_mm > 10 THEN 'rain'
                WHEN weather_precip_mm > 0 THEN 'light_rain' ELSE 'no_rain' END AS precip_category,
            count(*) AS tweet_count, {avg('sentiment_score', 3)} AS avg_sentiment
        FROM analytics WHERE weather_temp_c IS NOT NULL GROUP BY 1, 2""",
    "q10_heatmap_export": """
        SELECT geo_lat, geo_lon, sentiment_score, sentiment_label, weather_event_type, text_clean,
            created_at
        FROM analytics WHERE sentiment_label = 'negative' AND geo_lat IS NOT NULL
            AND geo_lon IS NOT NULL ORDER BY sentiment_score, tweet_id LIMIT 1000""",
    "heat_points": """
        SELECT geo_lat, geo_lon, abs(sentiment_score) AS weight FROM analytics
        WHERE sentiment_label = 'negative' AND geo_lat IS NOT NULL AND geo_lon IS NOT NULL
        ORDER BY sentiment_score, tweet_id LIMIT 1000""",
    "total_counts": """
        SELECT (SELECT count(*) FROM processed) AS total_tweets,
            (SELECT count(*) FROM analytics) AS quality_tweets""",
    "chart_sentiment_by_event": f"""
        SELECT weather_event_type, count(*) AS tweet_count, {avg('sentiment_score', 10)} AS avg_sentiment
        FROM analytics WHERE weather_event_type IS NOT NULL GROUP BY weather_event_type""",
    "chart_negative_locations": f"""
        SELECT round(geo_lat, 2) AS lat, round(geo_lon, 2) AS lon, place_name,
            count(*) AS negative_count, {avg('sentiment_score', 10)} AS avg_sentiment,
            {avg('weather_temp_c', 10)} AS avg_temp, {avg('weather_precip_mm', 10)} AS avg_precip,
            {avg('weather_wind_speed_ms', 10)} AS avg_wind, max(weather_event_type) AS primary_event
        FROM analytics WHERE sentiment_label = 'negative'
        GROUP BY round(geo_lat, 2), round(geo_lon, 2), place_name
        ORDER BY negative_count DESC, lat NULLS LAST, lon NULLS LAST, place_name NULLS LAST
        LIMIT 10""",
    "chart_daily_trend": f"""
        SELECT processing_date, {avg('sentiment_score', 10)} AS avg_sentiment, count(*) AS tweet_count
        FROM analytics GROUP BY processing_date""",
    "stats_language_share": f"""
        SELECT lang, n, {r('n * 100.0 / total', 1)} AS pct
        FROM (SELECT lang, count(*) AS n, (SELECT count(*) FROM posts) AS total
              FROM posts GROUP BY lang) ORDER BY n DESC, lang LIMIT 10""",
    "stats_geo_availability": f"""
        SELECT *, {r('with_coordinates * 100.0 / total', 1)} AS coordinates_pct,
            {r('with_place * 100.0 / total', 1)} AS place_pct,
            {r('with_user_location * 100.0 / total', 1)} AS user_location_pct
        FROM (SELECT count(*) AS total, count(pt_lat) AS with_coordinates,
                count(c.place_id) AS with_place, count(user_location) AS with_user_location
              FROM posts LEFT JOIN centres c USING (place_id))""",
    "stats_top_hashtags": """
        SELECT lower(tag) AS tag, count(*) AS n FROM (SELECT unnest(hashtags) AS tag FROM posts)
        GROUP BY 1 ORDER BY n DESC, tag LIMIT 10""",
    "quality_gate": f"""
        SELECT *, pct > target AS passed FROM (
            SELECT 'weather_match' AS check_name, 30.0::DOUBLE AS target,
                {r("count(*) FILTER (noaa_match_quality IN ('high', 'medium', 'low')) * 100.0 / count(*)", 3)} AS pct
            FROM processed UNION ALL
            SELECT 'geo_coverage', 50.0::DOUBLE,
                {r("count(*) FILTER (geo_confidence IN ('high', 'medium')) * 100.0 / count(*)", 3)}
            FROM processed)""",
}

DETAIL = {
    "scan_json": """
        SELECT id, created_at, author_id, lang, user_location, md5(text) AS text_md5, place_id,
            pt_lon AS lon, CAST(len(hashtags) AS INTEGER) AS n_tags, retweet_count FROM posts""",
    "scan_json_array": "SELECT id, created_at, lang, md5(text) AS text_md5 FROM posts",
    "incremental_since_id": """
        SELECT id, author_id, created_at FROM posts
        WHERE k > (SELECT max(conv_id) FROM conversations)""",
    "high_water_mark": "SELECT CAST(max(k) AS VARCHAR) AS high_water_mark FROM posts",
    "scan_partitioned_parquet": """
        SELECT tweet_id, processing_date, sentiment_score, text_length FROM processed""",
    "sql_table_scan": """
        SELECT processing_date, geo_confidence, count(*) AS n,
            CAST(sum(text_length) AS BIGINT) AS sum_text_length
        FROM processed GROUP BY processing_date, geo_confidence""",
    "partition_counts": "SELECT processing_date, count(*) AS n_rows FROM processed GROUP BY processing_date",
    "verify_output": """
        SELECT sentiment_label AS item, count(*) AS n FROM processed GROUP BY sentiment_label
        UNION ALL SELECT 'total', count(*) FROM processed""",
    "final_analytics": "SELECT * FROM analytics",
    "raw_json_roundtrip": """
        SELECT id, created_at, author_id, md5(text) AS text_md5, place_id,
            CAST(len(hashtags) AS INTEGER) AS n_tags FROM posts""",
    "raw_json_audit": """
        SELECT id AS tweet_id, ts AS created_at, strftime(ts, '%Y-%m-%d') AS processing_date,
            md5(text) AS text_md5 FROM posts""",
    "flatten_post": """
        SELECT id AS tweet_id, created_at, author_id, lang, user_location, repost AS retweet_status,
            retweet_count, md5(text) AS text_md5, pt_lat AS lat, pt_lon AS lon FROM posts""",
    "parse_post": """
        SELECT id AS tweet_id, author_id, ts AS created_at, created_at AS created_at_str, lang,
            repost AS retweet_status, retweet_count, CAST(len(hashtags) AS INTEGER) AS hashtag_count,
            CAST(len(mentions) AS INTEGER) AS mention_count, CAST(len(urls) AS INTEGER) AS url_count,
            'parsed' AS processing_stage FROM posts""",
    "entity_flatten": """
        SELECT id AS tweet_id, array_to_string(hashtags, '|') AS hashtags,
            array_to_string(mentions, '|') AS mentions, array_to_string(urls, '|') AS urls,
            CAST(len(hashtags) AS INTEGER) AS hashtag_count,
            CAST(len(mentions) AS INTEGER) AS mention_count,
            CAST(len(urls) AS INTEGER) AS url_count FROM posts""",
    "parse_timestamps": f"SELECT doc_key, {timestamp('created_at')} AS parsed_at FROM messy",
    "repost_flag": "SELECT id, starts_with(text, 'RT @') AS retweet_status FROM posts",
    "required_fields": "SELECT doc_key, reject_reason FROM reasons",
    "report_parse": """
        SELECT count(*) FILTER (reject_reason IS NULL) AS processed, count(reject_reason) AS failed,
            count(*) FILTER (reject_reason = 'missing_tweet_id') AS missing_tweet_id,
            count(*) FILTER (reject_reason = 'missing_text') AS missing_text,
            count(*) FILTER (reject_reason = 'missing_created_at') AS missing_created_at,
            count(*) FILTER (reject_reason = 'blank_text') AS blank_text,
            count(*) FILTER (reject_reason = 'bad_timestamp') AS bad_timestamp FROM reasons""",
    "topic_filter": r"""
        SELECT id, lang, created_at FROM posts WHERE NOT repost AND regexp_matches(text,
        '(?i)(?:\b(?:storm|cyclone|flood|heatwave|wildfire)\b|#(?:climatechange|climate|weather)\b)')""",
    "topic_filter_lang": r"""
        SELECT id, created_at FROM posts WHERE NOT repost AND lang = 'en' AND regexp_matches(text,
        '(?i)(?:\b(?:storm|cyclone|flood|heatwave|wildfire)\b|#(?:climatechange|climate|weather)\b)')""",
    "drop_reposts": """
        SELECT tweet_id, created_at, md5(text) AS text_md5 FROM arrivals WHERE NOT retweet_status""",
    "dedup_by_id": _kept("first_ids"),
    "dedup_by_text": """
        SELECT tweet_id, created_at, h AS text_hash FROM (SELECT *, row_number() OVER (
            PARTITION BY h ORDER BY created_at, tweet_id) AS rn FROM arrivals) WHERE rn = 1""",
    "dedup_chain": _kept("chain"),
    "dedup_outcomes": """
        SELECT tweet_id, created_at, text_hash, dedup_outcome, count(*) AS n_rows
        FROM outcomes GROUP BY ALL""",
    "report_dedup": f"""
        SELECT *, {r('(duplicates_dropped + retweets_dropped) * 100.0 / processed', 1)} AS drop_rate
        FROM (SELECT count(*) AS processed, count(*) FILTER (dedup_outcome = 'kept') AS unique_emitted,
            count(*) FILTER (dedup_outcome IN ('dup_id', 'dup_text')) AS duplicates_dropped,
            count(*) FILTER (dedup_outcome = 'repost') AS retweets_dropped FROM outcomes)""",
    "dedup_vs_history": f"""
        SELECT CAST(doc_id AS VARCHAR) AS tweet_id, md5(text) AS text_md5 FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)
            AND {text_hash('text')} NOT IN (SELECT {text_hash('d.text')} FROM documents d
                JOIN labels l ON l.doc_id = d.doc_id AND l.quality = 0)""",
    "nfkc": "SELECT id AS tweet_id, md5(t0) AS text_md5, CAST(length(t0) AS INTEGER) AS n FROM normal",
    "emoji_features": """
        SELECT id AS tweet_id, array_to_string(emojis, '') AS emojis,
            CAST(emoji_count AS INTEGER) AS emoji_count FROM cleaned""",
    "emoji_score": "SELECT id AS tweet_id, emoji_sentiment_score FROM cleaned",
    "emoji_tokens": f"""
        SELECT tweet_id, md5(x) AS text_md5, CAST(length(x) AS INTEGER) AS n
        FROM (SELECT id AS tweet_id, {emoji_spelled('t0')} AS x FROM normal)""",
    "hashtag_decompose": f"""
        SELECT id AS tweet_id, array_to_string(list_transform(hashtags, lambda t: {camel('t')}), '|')
            AS words, md5({hashtags_spelled('t0')}) AS text_md5 FROM normal""",
    "strip_urls": f"SELECT id AS tweet_id, md5({strip_urls('text')}) AS text_md5 FROM posts",
    "expand_contractions": f"SELECT id AS tweet_id, md5({contractions('text')}) AS text_md5 FROM posts",
    "normalize_ws": f"SELECT id AS tweet_id, md5({normalize_ws('text')}) AS text_md5 FROM posts",
    "strip_ws": f"SELECT id AS tweet_id, {text_hash('text')} AS text_hash FROM posts",
    "text_features_of_posts": f"""
        SELECT tweet_id, CAST(length(t) AS INTEGER) AS text_length, CAST(n AS INTEGER) AS word_count,
            has_media, {r('CASE WHEN n > 0 THEN length(t) / n ELSE 0 END', 2)} AS avg_word_length
        FROM (SELECT id AS tweet_id, len(urls) > 0 AS has_media, {normalize_ws('text')} AS t,
              len(list_filter(string_split({normalize_ws('text')}, ' '), lambda w: w <> '')) AS n FROM posts)""",
    "clean_text": f"""
        SELECT id AS tweet_id, text_clean, CAST(emoji_count AS INTEGER) AS emoji_count,
            emoji_sentiment_score, CAST(text_length AS INTEGER) AS text_length,
            CAST(word_count AS INTEGER) AS word_count, has_media,
            {r('CASE WHEN word_count > 0 THEN text_length / word_count ELSE 0 END', 2)} AS avg_word_length,
            CAST(len(hashtags) AS INTEGER) AS hashtag_count,
            CAST(len(mentions) AS INTEGER) AS mention_count,
            CAST(len(urls) AS INTEGER) AS url_count, 'cleaned' AS processing_stage FROM cleaned""",
    "join_place": """
        SELECT id, c.place_id, c.full_name FROM posts LEFT JOIN centres c USING (place_id)""",
    "join_user_location": "SELECT id, author_id, user_location FROM located_raw",
    "place_centroids": "SELECT place_id AS id, full_name, lat, lon FROM centres",
    "gazetteer_join": f"""
        SELECT l.id AS tweet_id, lower({pytrim('l.user_location')}) AS location_key,
            g.lat AS gaz_lat, g.lon AS gaz_lon
        FROM located_raw l LEFT JOIN gazetteer g ON lower({pytrim('l.user_location')}) = g.location_key""",
    "geo_resolve": "SELECT * EXCLUDE (created_at) FROM geo",
    "report_geo_tiers": _shares("geo_confidence", ["high", "medium", "low", "unavailable"], "geo"),
    "haversine": f"""
        SELECT t.id, g.location_key,
            {r(haversine('t.latitude', 't.longitude', 'g.lat', 'g.lon'), 6)} AS distance_km
        FROM stations t JOIN supplier u ON t.id = 'ST' || u.s_suppkey
            JOIN gazetteer g ON g.location_key = 'nation_' || u.s_nationkey""",
    "nearest_station": f"""
        SELECT p.lat, p.lon, n.st.id AS station_id, n.st.name AS station_name,
            {r('n.st.d', 2)} AS distance_km, n.st.la AS station_lat, n.st.lo AS station_lon,
            n.st.el AS station_elevation
        FROM (SELECT DISTINCT geo_lat AS lat, geo_lon AS lon FROM geo WHERE geo_lat IS NOT NULL) p
            LEFT JOIN nearest n USING (lat, lon)""",
    "observation_units": """
        SELECT station_id, strftime(obs_at, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", datatype, value,
            CASE WHEN datatype = 'TMAX' THEN value / 10 END AS temperature_max_c,
            CASE WHEN datatype = 'TMIN' THEN value / 10 END AS temperature_min_c,
            CASE WHEN datatype = 'PRCP' THEN value / 10 END AS precipitation_mm,
            CASE WHEN datatype = 'AWND' THEN value / 10 END AS wind_speed_ms,
            CASE WHEN datatype = 'SNOW' THEN value END AS snowfall_mm FROM observations""",
    "observations_needed": """
        SELECT station_id, strftime(obs_at, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", datatype, value
        FROM observations o WHERE EXISTS (
            SELECT 1 FROM stationed s WHERE s.station_id = o.station_id
                AND s.created_at >= TIMESTAMP '2024-01-08' AND s.created_at < TIMESTAMP '2024-01-15'
                AND CAST(o.obs_at AS DATE) BETWEEN CAST(s.created_at - INTERVAL 1 HOUR AS DATE)
                    AND CAST(s.created_at + INTERVAL 1 HOUR AS DATE))""",
    "observation_window_join": """
        SELECT tweet_id, station_id, count(*) AS n_obs FROM windowed GROUP BY tweet_id, station_id""",
    "weather_rollup": """
        SELECT tweet_id, weather_temp_c, weather_temp_max_c, weather_temp_min_c, weather_precip_mm,
            weather_wind_speed_ms FROM rollup""",
    "closest_observation": f"""
        SELECT tweet_id, strftime(closest_at, '%Y-%m-%dT%H:%M:%S') AS weather_observation_time,
            {r('diff / 60000000.0::DOUBLE', 6)} AS minutes FROM rollup""",
    "weather_event_class": "SELECT tweet_id, weather_event_type FROM weather",
    "match_quality": "SELECT tweet_id, weather_station_distance_km, noaa_match_quality FROM weather",
    "weather_enrich": "SELECT * FROM weather",
    "report_weather": _shares(
        "weather_outcome", ["enriched", "no_station", "no_observations", "no_geo"], "weather"
    ),
    "lang_profiles": "SELECT lang, gram, weight FROM profiles",
    "lang_profile_score": "SELECT tweet_id, det_lang, det_conf FROM detected",
    "lang_cascade": "SELECT * FROM lang_tags",
    "report_lang_method": f"""
        SELECT lang_method, count(*) AS n,
            {r('count(*) * 100.0 / (SELECT count(*) FROM lang_tags)', 1)} AS pct
        FROM lang_tags GROUP BY lang_method""",
    "lexicon_sentiment": f"""
        SELECT tweet_id, raw_score, {r('abs(raw_score)', 3)} AS raw_confidence,
            'lexicon' AS raw_method FROM lexicon_scores_by_rules""",
    "sentiment_route": """
        SELECT tweet_id, sentiment_score, sentiment_label,
            CASE WHEN lang = 'en' THEN 'lexicon_en' ELSE 'lexicon_multi' END AS sentiment_method,
            sentiment_confidence FROM sentiments JOIN cleaned ON id = tweet_id""",
    "report_sentiment": _shares("sentiment_label", ["positive", "neutral", "negative"], "sentiments"),
    "sentiment_finalize": f"""
        SELECT tweet_id, {r('s', 3)} AS final_score, CASE WHEN s > 0.3 THEN 'positive'
            WHEN s < -0.3 THEN 'negative' ELSE 'neutral' END AS final_label
        FROM (SELECT tweet_id, greatest(-1.0::DOUBLE, least(1.0::DOUBLE, sentiment_score +
            greatest(-0.2::DOUBLE, least(0.2::DOUBLE,
                emoji_sentiment_score * 5 * 0.2::DOUBLE)))) AS s FROM processed)""",
    "label_to_score": """
        SELECT tweet_id, CASE sentiment_label WHEN 'positive' THEN sentiment_confidence
            WHEN 'negative' THEN -sentiment_confidence ELSE 0.0::DOUBLE END AS raw_score FROM processed""",
    "enriched_posts": "SELECT * FROM enriched",
    "enriched_distribution": f"""
        SELECT sentiment_label, count(*) AS tweet_count, {avg('sentiment_score', 3)} AS avg_score,
            {avg('sentiment_confidence', 3)} AS avg_confidence FROM enriched GROUP BY sentiment_label""",
    "stream_daily_trend": TREND.format(avg=avg("sentiment_score", 6)),
    "stream_sliding_trend": f"""
        SELECT w AS window_start, w + INTERVAL 6 HOUR AS window_end, count(*) AS tweet_count,
            {avg("score", 6)} AS avg_sentiment, count(*) FILTER (score > 0.3) AS positive_count,
            count(*) FILTER (score BETWEEN -0.3 AND 0.3) AS neutral_count,
            count(*) FILTER (score < -0.3) AS negative_count
        FROM (SELECT score, unnest(generate_series(date_trunc('hour', ts) - INTERVAL 5 HOUR,
                date_trunc('hour', ts), INTERVAL 1 HOUR)) AS w
              FROM (SELECT {_time('doc_id')} AS ts, (doc_id * 17 % 2001 - 1000) / 1000.0::DOUBLE AS score FROM documents))
        GROUP BY w""",
    "stream_sessions": f"""
        SELECT author_id, min(ts) AS first_at, max(ts) AS last_at, count(*) AS tweet_count, {avg("score", 6)} AS avg_sentiment
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY author_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island
              FROM (SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY author_id ORDER BY ts) + INTERVAL 90 MINUTE
                        THEN 0 ELSE 1 END AS fresh
                    FROM (SELECT CAST(doc_id % 10 AS VARCHAR) AS author_id, {_time('doc_id')} AS ts,
                            (doc_id * 17 % 2001 - 1000) / 1000.0::DOUBLE AS score FROM documents)))
        GROUP BY author_id, island""",
    # A memory of the keys used last holds a key if fewer others were used since.
    "stream_dedup_lru": f"""
        WITH seen AS (
            SELECT doc_id AS n, CAST(doc_id * doc_id % 97 AS VARCHAR) AS text,
                row_number() OVER (ORDER BY {_time('doc_id')}, doc_id) AS i FROM documents),
        turn AS (SELECT *, coalesce(lag(i) OVER (PARTITION BY text ORDER BY i), 0) AS before FROM seen)
        SELECT n, text FROM turn t WHERE before = 0 OR 32 <= (
            SELECT count(*) FROM turn o WHERE o.i > t.before AND o.i < t.i AND o.before <= t.before)""",
    "late_of_stream": f"""
        WITH arrived AS (SELECT doc_id, {_time('doc_id')} AS ts, doc_id % 4 AS part FROM documents)
        SELECT doc_id, CASE WHEN ts <= (SELECT max(o.ts) - INTERVAL 10 DAY FROM arrived o WHERE o.part < p.part)
            THEN 'late' ELSE 'in_time' END AS output FROM arrived p""",
    "stream_dedup_posts": f"SELECT DISTINCT {text_hash('text')} AS text_hash FROM documents",
    "stream_enriched": """
        SELECT detected_lang, sentiment_label, count(*) AS n,
            CAST(sum(text_length) AS BIGINT) AS sum_text_length
        FROM enriched GROUP BY detected_lang, sentiment_label""",
    "stream_table_scan": """
        SELECT detected_lang, lang_method, count(*) AS n, CAST(sum(text_length) AS BIGINT) AS sum_text_length
        FROM enriched GROUP BY detected_lang, lang_method""",
    "rejects_of_chain": "SELECT tweet_id, reject_reason, count(*) AS n FROM faults WHERE fault <> 6 GROUP BY ALL",
    "raw_audit_of_chain": """
        SELECT id AS tweet_id, '2024-01-31' AS processing_date, md5(text) AS text_md5 FROM survivors""",
    "rejects_of_stream": """
        SELECT CASE WHEN fault <> 6 THEN tweet_id END AS tweet_id, reject_reason,
            CASE WHEN fault = 6 THEN md5('{"id": "' || k || '", "text": ') END AS line_md5, count(*) AS n
        FROM faults GROUP BY ALL""",
    "dedup_greedy": """
        SELECT tweet_id, created_at, text_hash FROM (
            WITH RECURSIVE ordered AS (
                SELECT *, row_number() OVER (ORDER BY created_at, tweet_id, h) AS pos
                FROM (SELECT tweet_id, h, min(created_at) AS created_at FROM arrivals
                      WHERE NOT retweet_status GROUP BY tweet_id, h)),
            walk AS (
                SELECT CAST(0 AS BIGINT) AS pos, CAST([] AS VARCHAR[]) AS ids,
                    CAST([] AS VARCHAR[]) AS hashes
                UNION ALL
                SELECT o.pos,
                    CASE WHEN list_contains(ids, o.tweet_id) OR list_contains(hashes, o.h)
                        THEN ids ELSE list_append(ids, o.tweet_id) END,
                    CASE WHEN list_contains(ids, o.tweet_id) OR list_contains(hashes, o.h)
                        THEN hashes ELSE list_append(hashes, o.h) END
                FROM walk w JOIN ordered o ON o.pos = w.pos + 1),
            final AS (SELECT unnest(ids) AS tweet_id, unnest(hashes) AS h
                      FROM (SELECT * FROM walk ORDER BY pos DESC LIMIT 1))
            SELECT o.tweet_id, o.created_at, o.h AS text_hash FROM ordered o JOIN final USING (tweet_id, h))""",
}

# The reports over the chain's posts: the same SQL, with another source and the group in one column.
CHAIN_REPORTS = {
    "locations": ("q2_negative_locations", "concat(CAST(round(lat * 100) AS BIGINT), '|', "
                  "CAST(round(lon * 100) AS BIGINT), '|', coalesce(place_name, '-'))"),
    "events": ("q3_sentiment_by_event", "weather_event_type"),
    "days": ("q4_daily_trend", "processing_date"),
    "languages": ("q5_language_distribution", "concat(detected_lang, '|', sentiment_method)"),
    "tiers": ("q6_geo_quality", "geo_confidence"),
    "matches": ("q7_match_quality", "noaa_match_quality"),
    "emoji": ("q8_emoji_buckets", "emoji_category"),
    "severity": ("q9_weather_severity", "concat(temp_category, '|', precip_category)"),
}


def _chain_report(name: str, report: str, group: str) -> str:
    body = REPORTS[report].replace("FROM analytics", "FROM chain_analytics").replace("FROM processed", "FROM chain_posts")
    size = "negative_tweet_count" if name == "locations" else "tweet_count"
    return f"SELECT '{name}' AS report, {group} AS of_group, {size} AS tweet_count, avg_sentiment FROM ({body})"


DETAIL["enriched_reports"] = " UNION ALL ".join(_chain_report(name, *made) for name, made in CHAIN_REPORTS.items())
DETAIL["lexicon_sentiment_joined"] = DETAIL["lexicon_sentiment"]
DETAIL["stream_since_id"] = DETAIL["incremental_since_id"]
DETAIL["lang_profile_score_joined"] = DETAIL["lang_profile_score"]
ORACLES: dict[str, str] = {name: _q(sql) for name, sql in (DETAIL | REPORTS).items()}
