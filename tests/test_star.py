"""Dimensions, facts, checks, alerts, policies, publication."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltbed.functions.masking import mask_ip, mask_user, register_masks
from siltbed.functions.languages import language_name
from siltbed.operators import alerts, checks, dimensions, facts, policies
from siltbed.plans import analytics, jobs
from siltbed.plans import feed, store
from siltbed.plans.publish import (
    Publication, create_if_absent, exists, publish_all, publish_table, published_or_none, snapshot_backup, view_of,
)
from siltbed.schemas import FACT, REFERENCE
from siltbed.sources import sites

NOW = dt.datetime(2024, 5, 2, 12, 0)
CLEAN = (
    "event_id BIGINT, wiki STRING, bot BOOLEAN, user STRING, title STRING, event_time TIMESTAMP, "
    "silver_ingested_at TIMESTAMP, length_old BIGINT, length_new BIGINT, minor BOOLEAN"
)


def reference(spark):
    return spark.createDataFrame(
        [("enwiki", "English pages", "en", "https://e"), ("xwiki", None, None, None)], REFERENCE
    )


def clean(spark):
    return spark.createDataFrame(
        [
            (71, "enwiki", True, "Sweeper", "Canal", NOW, NOW, 400, 431, True),
            (72, "nowhere", False, "Mira", "Bridge", NOW, NOW, 96, 52, False),
            (73, None, None, None, None, None, NOW, None, 8, None),
        ],
        CLEAN,
    )


def star(spark):
    projects = dimensions.dim_project(reference(spark))
    dates = dimensions.dim_date(dimensions.calendar_between(spark, "2024-01-01", "2024-12-31"))
    return projects, dates, facts.fact_edits(clean(spark), projects)


def test_default_calendar(spark):
    dates = dimensions.dim_date(dimensions.calendar_between(spark))
    assert dates.count() == 1095
    row = dates.filter("date_key = 20260815").first()
    assert (row.month_name, row.day_name, row.day_of_week, row.is_weekend, row.quarter) == (
        "August", "Saturday", 7, True, 3,
    )


def test_calendar_bounds_cover_whole_years(spark):
    times = spark.createDataFrame([(NOW, dt.datetime(2025, 2, 1))], "a TIMESTAMP, b TIMESTAMP")
    row = dimensions.calendar_bounds(times, "a", "b").first()
    assert (row.first_day, row.last_day) == (dt.date(2024, 1, 1), dt.date(2025, 12, 31))


@pytest.mark.parametrize(
    "code,name",
    [
        ("en", "English"), ("EN", "English"), ("simple", "Simple English"), ("yue", "Cantonese"),
        ("no", "Norwegian (Bokmål)"), ("be-tarask", "Belarusian (Taraškievica)"), ("nqo", "N'Ko"),
        ("unknown", "Other / Technical"), ("commons", "ISO: COMMONS"), ("zz", "ISO: ZZ"),
        ("zh-classical", "ISO: ZH-CLASSICAL"), ("als", "ISO: ALS"), ("vo", "Volapük"),
        ("ckb", "Central Kurdish (Sorani)"), ("tok", "Toki Pona"), ("ia", "Interlingua"), ("bho", "Bhojpuri"),
    ],
)
def test_language_names(spark, code, name):
    assert spark.range(1).select(language_name(F.lit(code)).alias("n")).first().n == name


def test_own_language_table(spark):
    names = spark.createDataFrame([("EN", "Anglais")], "language_code STRING, language_name STRING")
    rows = {r.wiki_code: r.language_name for r in dimensions.dim_project(reference(spark), names=names).collect()}
    assert rows == {"enwiki": "Anglais", "xwiki": "Other / Technical", "unknown": "Other / Technical"}


def test_facts(spark):
    projects, _, rows = star(spark)
    found = {r.event_id: r for r in rows.collect()}
    keys = {r.wiki_code: r.project_key for r in projects.collect()}
    assert (found[71].project_key, found[71].editor_type_key) == (keys["enwiki"], 1)
    assert {found[n].project_key for n in (72, 73)} == {keys["unknown"]}
    assert (found[71].byte_change, found[72].abs_byte_change) == (31, 44)
    assert found[73].byte_change is None and found[73].is_minor_edit is False
    assert (found[73].date_key, found[73].editor_type_key) == (20240502, 2)


def test_checks_pass_then_fail_when_corrupted(spark):
    projects, dates, rows = star(spark)
    checks.require_clean(checks.gold_checks(clean(spark), rows, projects, dates))
    with pytest.raises(checks.CheckFailed, match="silver_gold"):
        checks.require_clean(checks.gold_checks(clean(spark), rows.union(rows), projects, dates))
    with pytest.raises(checks.CheckFailed, match="project_referential"):
        checks.require_clean(
            checks.check_project_ri(rows, projects.filter("wiki_code <> 'enwiki'"))
        )
    with pytest.raises(checks.CheckFailed, match="date_referential"):
        checks.require_clean(checks.check_date_ri(rows, dates.filter("month > 6")))
    with pytest.raises(checks.CheckFailed, match="unique_project_keys"):
        checks.require_clean(checks.check_unique_project_keys(projects.union(projects)))
    with pytest.raises(checks.CheckFailed):
        checks.require_clean(checks.gold_not_empty(rows.filter("false")))


def test_reference_checks(spark):
    projects, _, _ = star(spark)
    assert checks.reference_checks(reference(spark), projects).first().passed
    row = checks.reference_checks(reference(spark), projects.filter("wiki_code <> 'xwiki'")).first()
    assert not row.passed and row.missing_projects == 1
    assert not checks.reference_checks(reference(spark).filter("false"), projects).first().passed


def test_preflight_and_reference_gate(spark):
    projects, dates, _ = star(spark)
    editors = dimensions.dim_editor_type(spark)
    assert facts.fact_preflight(dates, editors, projects).first().ready
    no_fallback = projects.filter("wiki_code <> 'unknown'")
    for args in (
        (dates.filter("false"), editors, projects), (dates, editors.filter("false"), projects),
        (dates, editors, no_fallback), (dates, editors, projects.union(projects)),
        (dates, editors, projects.filter("wiki_code = 'unknown'")),
    ):
        with pytest.raises(checks.CheckFailed):
            checks.require_true(facts.fact_preflight(*args), "ready")
    assert facts.reference_gate(reference(spark)).first().publishable
    for bad in (reference(spark).filter("false"), reference(spark).union(reference(spark))):
        assert not facts.reference_gate(bad).first().publishable


@pytest.mark.parametrize(
    "hours,code,stale", [(1, "enwiki", 0), (49, "enwiki", 1), (1, "unknown", 1), (None, None, 1)]
)
def test_freshness(spark, hours, code, stale):
    rows = [] if hours is None else [(code, NOW - dt.timedelta(hours=hours))]
    frame = spark.createDataFrame(rows, "wiki_code STRING, gold_updated_at TIMESTAMP")
    assert alerts.alert_freshness(frame, F.lit(NOW)).first().value == stale


def test_alert_rules(spark):
    values = spark.createDataFrame([("a", 0), ("b", 3), ("c", 2)], "alert STRING, value BIGINT")
    rules = spark.createDataFrame(
        [("a", "GREATER_THAN", 0.0), ("b", "GREATER_THAN", 0.0), ("c", "NOT_EQUAL", 2.0)],
        "alert STRING, operator STRING, threshold DOUBLE",
    )
    assert [r.alert for r in alerts.alert_eval(values, rules).collect()] == ["b"]


def test_masks(spark):
    users = spark.createDataFrame(
        [("10.20.3.7",), ("2001:db8::1",), ("Name.With.Dots.x",), ("ab",), (None,)], "user STRING"
    )
    handle = [r.m for r in users.select(mask_user(F.col("user")).alias("m")).collect()]
    assert handle == ["10***", "20***", "Na***", "ab***", None]
    network = [r.m for r in users.select(mask_ip(F.col("user")).alias("m")).collect()]
    assert network == ["10.20.xxx.xxx", "2001:db8:::xxxx", "Name.With.Dots.x", "ab", None]
    assert users.select(mask_user(F.col("user"), True).alias("m")).first().m == "10.20.3.7"
    register_masks(spark)
    row = spark.sql("SELECT mask_user('someone', false) a, mask_user('someone', true) b, edit_visible(3, false) c").first()
    assert (row.a, row.b, row.c) == ("so***", "someone", False)


def test_row_policies(spark):
    _, _, rows = star(spark)
    assert policies.row_policy(rows).count() == 3
    assert policies.row_policy(rows, policy="humans_only").count() == 2
    assert policies.row_policy(rows, True, "humans_only").count() == 3
    policies.secured_view(rows, "seen", policy="humans_only", mask="network")
    assert spark.table("seen").filter("editor_type_key = 1").count() == 0


def test_analytics_on_the_small_star(spark):
    projects, dates, rows = star(spark)
    editors = dimensions.dim_editor_type(spark)
    top = analytics.top_languages(rows, projects, editors, dates).collect()
    assert [(r.language_name, r.bot_edits, r.human_edits) for r in top] == [
        ("Other / Technical", 0, 2), ("English", 1, 0),
    ]
    exact, near = (analytics.kpi_summary(rows, a).first() for a in (False, True))
    assert exact.total_edits == 3 and exact.active_pages == near.active_pages == 2


def test_publication(spark, tmp_path):
    root = str(tmp_path)
    assert published_or_none(spark, root, "t_pub") is None
    assert create_if_absent(spark, "t_pub", FACT, root) and exists(spark, root, "t_pub")
    read = lambda name="t_pub", **at: store.read_table(spark.newSession(), root, name, **at)
    assert read().count() == 0 and not create_if_absent(spark, "t_pub", FACT, root)
    _, _, rows = star(spark)
    held = read()
    publish_table(rows, "t_pub", root, partition_by=["date_key"])
    assert read().count() == 3 and held.count() == 0  # a frame stays with the version it was opened on
    assert read().dtypes == rows.dtypes and read(number=1).count() == 0
    assert publish_table(rows.filter("false"), "t_none", root, partition_by=["date_key"]).dtypes == rows.dtypes
    assert read("t_none").count() == 0 and read().count() == 3
    with pytest.raises(checks.CheckFailed):
        publish_table(
            rows.filter("false"), "t_pub", root,
            lambda w: checks.require_clean(checks.gold_not_empty(w)),
        )
    assert read().count() == 3
    with pytest.raises(ValueError):
        publish_table(rows, "bad name; drop", root)
    with pytest.raises(KeyError):
        read("absent")
    with pytest.raises(KeyError):
        read(number=99)
    assert view_of(spark, root, "t_pub", "seen_pub").count() == spark.table("seen_pub").count() == 3
    snapshot_backup(rows, root + "/copy")
    snapshot_backup(rows.filter("false"), root + "/copy")
    assert spark.read.parquet(root + "/copy").count() == 3


def test_of_two_publishers_one_wins(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(3)
    start = store.snapshot(spark, root)
    assert start.number == 0 and not start.tables
    versions = [store.write_version(rows.limit(n), root, "t") for n in (1, 2)]
    store.commit(spark, root, {"t": versions[0]}, start.number)
    with pytest.raises(store.Conflict):
        store.commit(spark, root, {"t": versions[1]}, start.number)
    assert store.read_table(spark, root, "t").count() == 1
    assert not store._Files(spark, root).create(1, {"changed": [], "tables": {}})  # the number is taken
    assert store.commit(spark, root, {"t": versions[1]}).number == 2  # without an expectation the last one counts
    assert store.read_table(spark, root, "t").count() == 2
    assert not [f for f in (tmp_path / "_commits").iterdir() if "draft" in f.name]


def test_tables_change_together(spark, tmp_path):
    root = str(tmp_path)
    publish_all(spark, root, {"a": Publication(spark.range(1)), "b": Publication(spark.range(1))})

    def stop(written):
        raise checks.CheckFailed("stop")

    with pytest.raises(checks.CheckFailed):
        publish_all(spark, root, {"a": Publication(spark.range(5)), "b": Publication(spark.range(5), stop)})
    assert [store.read_table(spark, root, n).count() for n in "ab"] == [1, 1]
    publish_all(spark, root, {"a": Publication(spark.range(5)), "b": Publication(spark.range(5))})
    assert [store.read_table(spark, root, n).count() for n in "ab"] == [5, 5]


def test_feed(spark, tmp_path):
    root, copy = str(tmp_path / "source"), str(tmp_path / "copy")
    states = [
        [(1, "a", None), (2, "b", 1), (None, "n", 1)],
        [(1, "a", 5), (3, "c", 1), (None, "m", 1)],
        [(2, "b", 2), (3, "c", 1), (None, "m", 1)],
    ]
    ddl = "k int, name string, n int"
    for state in states:
        feed.publish_changes(spark.createDataFrame(state, ddl), "t", root, ["k"])
        assert feed.follow(spark, (root, "t"), copy, "t", ["k"]) == 1
        assert feed.follow(spark, (root, "t"), copy, "t", ["k"]) == 0
        rows = store.read_table(spark, copy, "t").collect()
        assert sorted(map(str, map(tuple, rows))) == sorted(map(str, state))
    changes, position = feed.changes_since(spark, root, "t", 1)
    assert position == 3 and feed.changes_since(spark, root, "t", 3) == (None, 3)
    kinds = sorted((r._commit, r._action, str(r.k)) for r in changes.collect())
    assert kinds == sorted([
        (2, "before", "1"), (2, "update", "1"), (2, "delete", "2"), (2, "insert", "3"), (2, "before", "None"), (2, "update", "None"),
        (3, "delete", "1"), (3, "insert", "2"),
    ])
    late = str(tmp_path / "late")
    assert feed.follow(spark, (root, "t"), late, "t", ["k"]) == 3
    assert store.read_table(spark, late, "t").count() == 3
    publish_table(spark.createDataFrame(states[0], ddl), "t", root)
    with pytest.raises(ValueError, match="without a change feed"):
        feed.follow(spark, (root, "t"), late, "t", ["k"])


def test_all_jobs(spark, tmp_path):
    root = str(tmp_path)
    raw = reference(spark).union(spark.createDataFrame([("bad", "B", "b", "www.b")], REFERENCE))
    found = jobs.publish_history(raw, F.lit(NOW).cast("timestamp"), root)
    assert [r.wiki_code for r in found[jobs.REJECTED_REFERENCE].collect()] == ["bad"]
    history = found[jobs.HISTORY]
    jobs.publish_reference(jobs.active_projects(history), root)
    jobs.publish_calendar(spark, dimensions.calendar_between(spark, "2024-01-01", "2024-12-31"), root)
    publish_table(clean(spark), jobs.CLEAN, root)
    for _ in range(2):
        assert jobs.publish_facts(spark, root).count() == 3
    publish_table(clean(spark).union(clean(spark)), jobs.CLEAN, root)
    held = store.snapshot(spark, root).number
    with pytest.raises(checks.CheckFailed):
        jobs.publish_reference(jobs.active_projects(history).filter("false"), root)
    for bad, at in ((raw.union(raw), NOW), (raw, NOW - dt.timedelta(days=1))):  # a project twice; older than the last
        with pytest.raises(checks.CheckFailed):
            jobs.publish_history(bad, F.lit(at).cast("timestamp"), root)
    assert store.snapshot(spark, root).number == held
    assert store.read_table(spark, root, jobs.PROJECTS).count() == 3


def test_the_inbox_is_read_once(spark, tmp_path):
    """Clean rows, quarantine and the check between them come from one pass over the inbox."""
    from siltbed.plans.refine import refine
    from siltbed.sources.recast import inbox

    source = str(tmp_path / "inbox")
    inbox(spark, "/root/testdata/sf0.001").write.parquet(source)
    rows = refine(spark.read.parquet(source))
    found = jobs.publish_events(rows, str(tmp_path / "gold"))
    for part in found.values():
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "from_json" not in plan and source not in plan
    total = sum(part.count() for part in found.values())
    assert 0 < total <= rows.count()


def test_site_listing(spark, tmp_path):
    text = """{"sitematrix":{"count":3,"0":{"code":"aa","site":[{"dbname":"aawiki","sitename":"A","url":"https://a"}]},
      "1":{"site":[{"dbname":"bwiki","sitename":"B","url":"https://b"}]},"2":{"code":"cc"},
      "specials":[{"dbname":"s","sitename":"S","url":"u","code":"meta"},{"dbname":"t"}]}}"""
    (tmp_path / "listing.json").write_text(text)
    landed = sites.landed_files(spark, str(tmp_path))
    assert landed.first().source_file.endswith("listing.json")
    rows = {r.wiki_code: (r.project_name, r.language_code, r.site_url) for r in sites.flatten_sites(landed).collect()}
    assert rows == {
        "aawiki": ("A", "aa", "https://a"), "bwiki": ("B", "unknown", "https://b"),
        "s": ("S", "meta", "u"), "t": (None, "special", None),
    }
    assert "_batch_run_id" in sites.batch_metadata(landed).columns
