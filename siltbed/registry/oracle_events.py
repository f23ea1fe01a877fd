"""DuckDB text shared by the event oracles: typed rows, rules and the star schema.

A broken payload means that every parsed field is NULL; nothing here reads JSON.
"""

from __future__ import annotations

from siltbed.sources.recast import BROKEN_TEXT, EVENT_FIELDS, REFERENCE_FIELDS, TWICE

_TYPED = {
    "event_id": "id",
    "event_type": "type",
    "namespace": "namespace",
    "title": "title",
    "comment": "comment",
    "event_timestamp_unix": "timestamp",
    '"user"': "user",
    "bot": "bot",
    "minor": "minor",
    "wiki": "wiki",
    "meta_id": "meta_id",
    "domain": "domain",
    "length_old": "length_old",
    "length_new": "length_new",
    "producer_source": "source",
}
_COLUMNS = ",\n    ".join(
    f"CASE WHEN NOT ({BROKEN_TEXT}) THEN {EVENT_FIELDS[field]} END AS {name}"
    for name, field in _TYPED.items()
)

EVENTS = f"""
ev AS (
  SELECT event_id AS e, user_id AS u, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
    event_type AS et, value AS v, epoch_us(ts) AS us, epoch_us(ts) // 1000000 AS secs,
    user_id % 30 AS n
  FROM events
),
typed AS (
  SELECT e, us, secs, n, ({BROKEN_TEXT}) AS _parse_error,
    {_COLUMNS},
    CASE WHEN NOT ({BROKEN_TEXT}) AND e % 61 <> 0 THEN secs END AS utc_epoch,
    CASE WHEN NOT ({BROKEN_TEXT}) AND e % 3 <> 0 THEN secs END AS producer_epoch
  FROM ev
),
derived AS (
  SELECT *, CASE WHEN bot THEN 'bot' ELSE 'human' END AS editor_type,
    length_new - length_old AS byte_change, abs(length_new - length_old) AS abs_byte_change,
    NOT _parse_error AS ok_json, event_id IS NOT NULL AS ok_id,
    event_timestamp_unix IS NOT NULL AS ok_time,
    coalesce(trim(wiki) <> '' AND trim(domain) <> '', false) AS ok_wiki,
    coalesce(length_old, 0) >= 0 AND coalesce(length_new, 0) >= 0 AS ok_length
  FROM typed
),
flagged AS (
  SELECT *, ok_json AND ok_id AND ok_time AND ok_wiki AND ok_length AS passed,
    concat_ws(',', CASE WHEN NOT ok_json THEN 'valid_json' END,
      CASE WHEN NOT ok_id THEN 'valid_event_id' END,
      CASE WHEN NOT ok_time THEN 'valid_event_time' END,
      CASE WHEN NOT ok_wiki THEN 'valid_wiki_domain' END,
      CASE WHEN NOT ok_length THEN 'valid_length' END) AS reasons
  FROM derived
),
delivered AS (
  SELECT *, 0 AS copy FROM flagged UNION ALL SELECT *, 1 AS copy FROM flagged WHERE {TWICE}
),
silver AS (SELECT * FROM flagged WHERE passed)"""

_NAMES = {
    "en": "English", "de": "German", "fr": "French", "es": "Spanish", "it": "Italian",
    "pt": "Portuguese", "ru": "Russian", "zh": "Chinese", "ja": "Japanese", "ko": "Korean",
    "ar": "Arabic", "fa": "Persian", "tr": "Turkish", "pl": "Polish", "nl": "Dutch",
    "sv": "Swedish", "uk": "Ukrainian", "cs": "Czech", "hu": "Hungarian", "zz": "ISO: ZZ",
    "commons": "ISO: COMMONS", "wikidata": "ISO: WIKIDATA", "unknown": "Other / Technical",
    "yue": "Cantonese", "simple": "Simple English",
}
LANGUAGE_CASE = (
    "CASE coalesce(language_code, 'unknown') "
    + " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in _NAMES.items())
    + " END"
)

REFERENCE = "ref AS (SELECT n_nationkey, {} FROM nation)".format(
    ", ".join(f"{text} AS {name}" for name, text in REFERENCE_FIELDS.items())
)

STAR = f"""{EVENTS},
{REFERENCE},
dim_project AS (
  SELECT md5(wiki_code) AS project_key, wiki_code, coalesce(language_code, 'unknown') AS language_code,
    {LANGUAGE_CASE} AS language_name, coalesce(project_name, 'Wikipedia') AS project_name, site_url
  FROM ref
  UNION ALL
  SELECT md5('unknown'), 'unknown', 'unknown', 'Other / Technical', 'Other project', NULL
),
cal AS (
  SELECT CAST(d AS DATE) AS calendar_date FROM (
    SELECT unnest(generate_series(date_trunc('year', min(ts)),
      date_trunc('year', max(ts)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM events)
),
dim_date AS (
  SELECT CAST(strftime(calendar_date, '%Y%m%d') AS INTEGER) AS date_key, calendar_date,
    CAST(year(calendar_date) AS INTEGER) AS "year", CAST(quarter(calendar_date) AS INTEGER) AS "quarter",
    CAST(month(calendar_date) AS INTEGER) AS "month", monthname(calendar_date) AS month_name,
    CAST(day(calendar_date) AS INTEGER) AS "day", CAST(dayofweek(calendar_date) + 1 AS INTEGER) AS day_of_week,
    dayname(calendar_date) AS day_name, dayofweek(calendar_date) IN (0, 6) AS is_weekend
  FROM cal
),
dim_editor AS (SELECT 1 AS editor_type_key, true AS is_bot, 'Bot' AS editor_type_desc
  UNION ALL SELECT 2, false, 'Human'),
fact AS (
  SELECT s.event_id, CAST(strftime(make_timestamp(s.secs * 1000000), '%Y%m%d') AS INTEGER) AS date_key,
    coalesce(p.project_key, md5('unknown')) AS project_key,
    CASE WHEN s.bot THEN 1 ELSE 2 END AS editor_type_key, s."user", s.title, s.secs AS event_epoch,
    make_timestamp(s.secs * 1000000) AS event_time, s.length_old, s.length_new, s.byte_change,
    s.abs_byte_change, coalesce(s.minor, false) AS is_minor_edit
  FROM silver s LEFT JOIN dim_project p ON coalesce(s.wiki, 'unknown') = p.wiki_code
)"""


def on_events(body: str) -> str:
    return f"WITH {EVENTS}\n{body}"


def on_reference(body: str) -> str:
    return f"WITH {REFERENCE}\n{body}"


def on_star(body: str) -> str:
    return f"WITH {STAR}\n{body}"
