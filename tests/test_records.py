import json

import pytest
from pyspark.sql import functions as F

from attesta.functions import text as T
from attesta.operators import browse, coverage, pool, records, resolve, runs, scan
from attesta.operators.protect import PublishGuardError
from attesta.sources import payload

LISTING = "ord int, title string, model string, model_identity string, brand string, cpu string, price double, numeric_keypad boolean, keyboard_backlight boolean, source string, source_url string, source_rank int, source_urls map<string,string>, evidence map<string,string>"


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


def listings(spark, rows):
    base = {"model": None, "model_identity": None, "brand": "Lenovo", "cpu": "i7-13700H", "price": None, "numeric_keypad": None, "keyboard_backlight": None, "source": "ZOL", "source_url": None, "source_rank": None, "source_urls": None, "evidence": None}
    return spark.createDataFrame([tuple((base | {"ord": i} | r)[c.split()[0]] for c in LISTING.replace("map<string,string>", "map").split(", ")) for i, r in enumerate(rows)], LISTING)


FACTS = "fact_id int, series string, size_inch string, numeric_keypad boolean, keyboard_backlight boolean, keyboard_text string, page_url string, source string"


def test_merge_folds_every_field(spark):
    rows = [
        {"title": "联想 Y7000P（16GB/1TB）", "source": "zol", "price": 1.0, "source_url": "z", "source_rank": 7, "numeric_keypad": True, "evidence": {"cpu": "a", "x": "1"}},
        {"title": "联想(Lenovo)Ｙ7000P 16G 1T", "source": "京东", "source_url": "j", "source_rank": 9, "numeric_keypad": True, "keyboard_backlight": True, "evidence": {"cpu": "b"}},
        {"title": "联想 Y7000P", "source": "中关村+jd", "price": 2.0, "source_rank": 3, "source_urls": {"zol": "z2", "京东": "j2"}, "keyboard_backlight": False},
        {"title": "联想 Y9000P", "source": "zol", "numeric_keypad": True, "keyboard_backlight": True},
    ]
    out = {r["title"]: r for r in records.merge_records(listings(spark, rows), "ord").collect()}
    assert len(out) == 2
    r = out["联想 Y7000P"] if "联想 Y7000P" in out else next(x for t, x in out.items() if "7000" in t)
    assert r["records"] == 3 and r["atomic_source_names"] == ["JD", "ZOL"] and r["source"] == "JD+ZOL" and r["source_count"] == 2 and r["price"] == 2.0
    assert r["source_urls"] == {"ZOL": "z", "JD": "j"} and r["source_ranks"] == {"ZOL": 3, "JD": 3} and r["source_rank"] == 3 and r["evidence"] == {"cpu": "b", "x": "1"}
    assert r["numeric_keypad"] is True and r["keyboard_backlight"] is False and not r["publish_eligible"] and r["rejection_reasons"] == ["keyboard_backlight_not_confirmed"]
    assert out["联想 Y9000P"]["publish_eligible"] and records.merge_records(listings(spark, rows).limit(0), "ord").count() == 0


def test_records_of_one_input_are_folded_before_identities_are_derived(spark, monkeypatch):
    import random

    rng = random.Random(5)
    rows = [{"title": f"联想 Y{rng.randrange(4)}", "source": rng.choice(["zol", "京东", "jd+zol"]), "price": rng.choice([None, 1.0, 2.0]), "source_url": rng.choice([None, "", f"u{i}"]), "source_rank": rng.choice([None, i]),
             "source_urls": rng.choice([None, {"zol": f"m{i}", "太平洋": ""}]), "evidence": rng.choice([None, {"cpu": f"e{i}"}, {f"x{i % 3}": f"y{i}"}]), "numeric_keypad": rng.choice([None, True])} for i in range(300)]
    written, staged = [], records.staged
    monkeypatch.setattr(records, "staged", lambda df, name: (out := staged(df, name), written.append(out.count()))[0])
    got = {r["title"]: r for r in records.merge_records(listings(spark, rows), "ord").collect()}
    assert written and max(written) <= 12 and len(got) == 4
    names = {"zol": ["ZOL"], "京东": ["JD"], "jd+zol": ["JD", "ZOL"]}
    for title, out in got.items():
        mine = [(i, r) for i, r in enumerate(rows) if r["title"] == title]
        filled = lambda r: sum(v is not None for v in r.values())
        base = sorted(mine, key=lambda x: (-(3 if x[1]["price"] else 0), -len(names[x[1]["source"]]), -filled(x[1]), x[0]))[0][1]
        urls, ranks, said = {}, {}, {}
        for i, r in mine:
            for source, url in [("ZOL", (r["source_urls"] or {}).get("zol"))] + [(s, r["source_url"]) for s in names[r["source"]]]:
                if url:
                    urls.setdefault(source, url)
            for source in names[r["source"]]:
                if r["source_rank"] is not None:
                    ranks[source] = min(ranks.get(source, 10**9), r["source_rank"])
            said |= r["evidence"] or {}
        assert (out["records"], out["price"], out["source_urls"], out["source_ranks"], out["evidence"]) == (len(mine), base["price"], urls, ranks, said)


def test_facts_fill_what_sources_leave_open(spark):
    facts = spark.createDataFrame([(0, "暗影精灵", "", True, None, "t0", "u0", "s"), (1, "暗影精灵 Pro", "16英寸", True, True, "t1", "u1", None), (2, "", "", True, True, "", "", ""), (3, "拯救者", "15英寸", True, True, "t3", "u3", "s")], FACTS)
    rows = [{"title": "惠普 暗影精灵Pro 16英寸", "keyboard_backlight": False}, {"title": "暗影精灵 15英寸"}, {"title": "拯救者 16英寸"}, {"title": "暗影精灵PRO 16英寸", "numeric_keypad": False, "cpu": "i5-12500H"}]
    out = {r["ord_"]: r for r in records.merge_records(listings(spark, rows).withColumn("ord_", F.col("ord")), "ord", facts).collect()}
    assert (out[0]["numeric_keypad"], out[0]["keyboard_backlight"]) == (True, False) and out[0]["evidence"]["numeric_keypad_fact"] == "t1" and out[0]["fact_sources"] == ["official"]
    assert (out[1]["numeric_keypad"], out[1]["keyboard_backlight"]) == (True, None) and out[1]["evidence"]["numeric_keypad_fact_url"] == "u0"
    assert out[2]["numeric_keypad"] is None and out[2]["fact_sources"] is None and out[3]["numeric_keypad"] is False and out[3]["keyboard_backlight"] is True


def test_contained_names_against_brute_force(spark):
    import random

    rng = random.Random(3)
    word = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(1, 3)))
    texts = [" ".join(word() for _ in range(rng.randint(0, 12))) for _ in range(60)] + [None, ""]
    names = [" ".join(word() for _ in range(rng.randint(1, 4))) for _ in range(40)] + ["", "  ", "a  b"]
    got = resolve.contained(spark.createDataFrame(list(enumerate(texts)), "k int, t string"), spark.createDataFrame(list(enumerate(names)), "fact_id int, name string"), "k", F.col("t"))
    assert {(r["k"], r["fact_id"]) for r in got.collect()} == {(k, i) for k, x in enumerate(texts) for i, n in enumerate(names) if n and x is not None and n in x}


def test_audit_and_publication(spark, tmp_path):
    rows = [{"title": f"联想 Y{i}", "source": "zol+jd" if i else "zol", "numeric_keypad": True, "keyboard_backlight": i != 3 or None, "source_rank": i} for i in range(5)]
    records.merge_records(listings(spark, rows), "ord").write.parquet(f"file://{tmp_path}/merged")
    merged = spark.read.parquet(f"file://{tmp_path}/merged")
    manifest = records.publish(merged, f"file://{tmp_path}/out", "2024-01-01T00:00:00+00:00", least=4, config='{"a": 1}').first()
    assert spark.read.text(f"file://{tmp_path}/out/filter_conditions").first()[0] == '{"a":1}'
    assert records.missing_identities(merged.where("title = '联想 Y1'"), merged).count() == 0 and [r[0] for r in records.missing_identities(merged, merged.where("title <> '联想 Y1'")).collect()] == [r[0] for r in merged.where("title = '联想 Y1'").select("identity_key").collect()]
    assert manifest["rowCount"] == 4 and manifest["sourceCounts"].asDict() == {"JD": 3, "ZOL": 4}
    items = [json.loads(r[0]) for r in spark.read.text(f"file://{tmp_path}/out/items").collect()]
    assert [x["title"] for x in items] == ["联想 Y1", "联想 Y2", "联想 Y4", "联想 Y0"]
    envelope = json.loads(spark.read.text(f"file://{tmp_path}/out/payload").first()[0])
    assert envelope["count"] == 4 and envelope["sources"] == ["JD", "ZOL"] and envelope["pipeline"]["rejected_count"] == 1
    assert json.loads(spark.read.text(f"file://{tmp_path}/out/rejected").first()[0])["reasons"] == ["keyboard_backlight_not_confirmed"]
    for wrong in ({"least": 5}, {"baseline": merged.withColumn("source", F.lit("pconline")).withColumn("atomic_source_names", F.array(F.lit("PConline")))}):
        with pytest.raises(PublishGuardError):
            records.publish(merged, f"file://{tmp_path}/no", "t", **wrong)
    assert not (tmp_path / "no").exists()
    good = merged.where("publish_eligible")
    assert records.audit_payload(good, 4).count() == 0
    errors = [r["error"] for r in records.audit_payload(good.unionAll(good.limit(1)).withColumn("source_count", F.lit(9)), 4).orderBy("check_ord", "row_ord").collect()]
    assert errors[0] == "count mismatch: metadata=4 actual=5" and errors[1] == "duplicate identity_key values" and sum("source_count mismatch" in e for e in errors) == 5
    out, counts = records.preserve(listings(spark, rows[:2]), good.drop("rejection_reasons"), "title")
    assert counts == {"candidate_count": 2, "baseline_count": 4, "preserved_count": 2} and out.where("publish_eligible").count() == 4
    assert records.preserve(listings(spark, rows[:2]), None, "title")[1]["baseline_count"] == 0


def test_coverage_of_three_domains(spark):
    cars = spark.createDataFrame([("7", "Ｍ 1", "2024", "懂车帝+汽车之家"), (None, "M 1", "2024", "仅懂车帝"), (None, None, "2024", "x")], "`车系ID` string, `车型` string, `年款` string, `数据来源` string")
    assert [r[0] for r in cars.coalesce(1).select(coverage.identity(cars, "cars")).collect()] == ["id:7|m 1|2024", "m 1|2024", None]
    laptops = spark.createDataFrame([("A" * 24, "x", "m"), (None, "Lenovo", " Y  1"), ("bad", "x", "m"), (None, None, "m")], "identity_key string, brand string, model string")
    assert [r[0] for r in laptops.coalesce(1).select(coverage.identity(laptops, "laptops")).collect()] == ["identity:" + "a" * 24, "lenovo|y 1", None, None]
    rows = spark.createDataFrame([(0, "b", "m", "仅zol"), (1, "b", "m", "单源：JD"), (2, "b", "n", "zol、 pdd"), (3, "b", "o", "dcd")], "i int, `品牌` string, `型号` string, `来源` string")
    report = coverage.analysis(rows, "phones", "i")
    assert report["total"] == 4 and report["single_count"] == 3 and report["multi_rate"] == 25.0 and report["causes"] == {"identity_only_single": 1, "cross_source_merge_gap": 2}
    assert report["source_distribution"] == {"JD": 1, "中关村在线": 1, "中关村在线+拼多多": 1, "懂车帝": 1} and report["top_single"][0]["identity"] == "b|m" and report["sample"][1]["sources"] == ["JD"]
    with pytest.raises(coverage.CoverageError):
        coverage.analysis(rows.withColumn("来源", F.lit("-")), "phones", "i")
    series = coverage.by_series(spark.createDataFrame([("s", "1", "懂车帝+易车"), ("s", "1", "仅懂车帝"), ("t", "2", "AH"), ("t", "2", "AH")], "s string, i string, src string"), "s", "i", "src")
    assert tuple(coverage.series_totals(series).first()) == (2, 1, 2, 1, 1)
    assert one(spark, "x JD y", lambda c: coverage.source_set(F.lit(None).cast("array<string>"), F.lit(None).cast("string"), c)) == ["JD"]


def test_scans(spark, tmp_path):
    cards = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "b"), (2, 2, "c"), (4, 1, "d")], "page_no int, place int, key string")
    pages = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "page_no int")
    assert [r["key"] for r in scan.scanned(pages, cards, "key", empty="prefix").collect()] == ["a", "b", "c"] and [r["key"] for r in scan.scanned(pages, cards, "key", 2, "prefix").collect()] == ["a", "b"]
    with pytest.raises(scan.ScanError):
        scan.scanned(pages, cards, "key")
    cursor, items = scan.advance(scan.Cursor(), None, cards.where("page_no < 3"), pages.where("page_no < 3"), "key")
    assert (cursor.current_page, cursor.scan_complete, cursor.total_items) == (3, False, 3)
    repeated = spark.createDataFrame([(p, 1, "a") for p in (3, 4, 5, 6)], "page_no int, place int, key string")
    cursor, items = scan.advance(cursor, items, repeated, repeated, "key")
    assert cursor.scan_complete and cursor.current_page == 6 and cursor.total_items == 3
    assert scan.advance(scan.Cursor(), None, cards, pages.where("page_no < 3"), "key", most=2)[0].scan_complete
    scan.save_cursor(spark, cursor, f"file://{tmp_path}/cursor")
    assert scan.load_cursor(spark, f"file://{tmp_path}/cursor") == cursor and scan.load_cursor(spark, f"file://{tmp_path}/none") == scan.Cursor()
    (tmp_path / "bad").write_text('{"current_page": "x", "processed_ids": 3')
    assert scan.load_cursor(spark, f"file://{tmp_path}/bad") == scan.Cursor() and scan.restarted(cursor) == scan.Cursor() and scan.restarted(cursor, False) is cursor
    done = spark.createDataFrame([("a", None), ("b", "detail_failed:x"), ("c", None)], "key string, crawl_warning string")
    assert scan.run_status(cursor, items, done, "key") == 0 and scan.run_status(cursor, items, done.limit(1), "key") == 10 and scan.processed(done, "key").count() == 2
    now = [0.0]
    budget = scan.Budget(5, lambda: now[0])
    assert not budget.expired() and budget.remaining() == 5
    now[0] = 6
    assert budget.expired() and budget.remaining() == 0 and not scan.Budget(0).expired()
    assert scan.enriched_only(done.withColumn("fetched_at", F.col("crawl_warning"))).count() == 1


def test_run_and_patch_checks(spark):
    assert one(spark, "Exit code: 10\n403", runs.log_class) == "site_breakage" and one(spark, "exit code 10 累计 300 403", runs.log_class) == "progress_exit" and one(spark, None, runs.log_class) == "unknown"
    assert [str(one(spark, x, runs.parsed_utc)) for x in ("2024-01-01T08:00:00+08:00", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00", "x")] == ["2024-01-01 00:00:00"] * 3 + ["None"]
    diff = "diff --git a/x.py b/x.py\n--- a/x.py\n+++ b/x.py\n@@\n+a\n-b\n"
    errors = lambda p, **k: one(spark, p, lambda c: runs.patch_errors(c, ["x.py"], **k))
    assert errors(diff) == [] and errors(diff, most_added=0) == ["too many changed lines"] and errors(diff.replace("b/x.py", "b/y.py")) == ["renamed or repeated path"] and "forbidden mark" in errors(diff + "rename to z") and errors("x")[0] == "no git diff"
    blocks = {"git add -A": True, "git add data/x": True, "git add ./data": True, "git add a.txt": False, "git add \\\n  database": False, "git add $(ls)": True, "git add 'x": True, "echo git add -A": False, "git add x \\": True, None: False, "git add 'data dir'": False}
    assert {b: one(spark, b, runs.stages_folder) for b in blocks} == blocks
    manifest = json.dumps({"request_id": "r", "prompt_sha256": "0" * 64})
    answer = lambda **k: tuple(one(spark, json.dumps({"request_id": "r", "prompt_sha256": "0" * 64, "proposal": {"a": 1}} | k), lambda c: runs.bound_answer(c, F.lit(manifest))))
    assert answer() == (None, '{"a":1}') and answer(request_id="q")[0] == "the answer is not bound to the manifest" and answer(proposal=[1])[0] == "the answer has no proposal"
    checks = spark.createDataFrame([(True,), (False,), (None,)], "ok boolean")
    assert tuple(runs.check_totals(checks, "ok").first()) == (3, 1, 2) and spark.range(1).select(runs.all_in(F.array(F.lit(1)), F.array(F.lit(1), F.lit(2)))).first()[0]
    order = spark.createDataFrame([("X", []), ("OPENROUTER", []), ("Y", ["m"]), ("ATOMGIT", []), ("ZEN", [])], "p string, m array<string>").orderBy(*runs.provider_order("p", "m"))
    assert [r["p"] for r in order.collect()] == ["ZEN", "ATOMGIT", "OPENROUTER", "Y", "X"]


def test_pool_and_display(spark, tmp_path):
    nodes = spark.createDataFrame([("a", 1, 9, 1), ("b", 2, 0, 0), ("c", 3, 0, 5)], "name string, o int, success int, fail int")
    assert [pool.round_robin(pool.available(nodes), "name", "o", k) for k in range(3)] == ["a", "b", "a"] and pool.round_robin(nodes.limit(0), "name", "o", 1) is None
    assert pool.available(nodes.where("name = 'c'")).count() == 1 and [tuple(r) for r in pool.listing(nodes, "name", "o").collect()] == [("a", "9/10"), ("b", "N/A"), ("c", "0/5")]
    schemas = {"nodes": "name string, o int", "stats": "name string, success int", "settings": "k string"}
    pool.save_pool(nodes.select("name", "o"), nodes.select("name", "success"), spark.createDataFrame([("x",)], "k string"), f"file://{tmp_path}/pool")
    assert {n: d.count() for n, d in pool.load_pool(spark, f"file://{tmp_path}/pool", schemas).items()} == {"nodes": 3, "stats": 3, "settings": 1} and pool.load_pool(spark, f"file://{tmp_path}/gone", schemas)["nodes"].count() == 0
    failed = spark.createDataFrame([("u", 1, "a", 0), ("u", 2, "b", 1), ("v", 1, "c", 9), ("w", 1, "a", 0)], "k string, t int, n string, rows int")
    got = {r["k"]: (r["current"], r["blocked"], r["next"]) for r in pool.failover(failed, nodes.withColumnRenamed("name", "n"), "k", "t", "n", "rows", "o").collect()}
    assert got == {"u": ("b", ["a", "b"], "c"), "v": ("c", [], None), "w": ("a", ["a"], "b")}
    assert one(spark, 4999.5, T.money, "double") == "¥5,000" and one(spark, None, T.money, "double") == "价格待确认" and one(spark, "<a>", T.display) == "&lt;a&gt;" and one(spark, 16.0, lambda c: T.display(c, "GB"), "double") == "16GB"
    config = {"forced": {"numeric_keypad": {"label": "键盘", "value": True}, "cpu_voltage_type": {"label": "CPU", "allowed_values": ["h"]}, "gpu_type": {"label": "x", "not_equals": "dedicated"}, "brand": {"label": "b", "value": "B"}}}
    assert browse.forced(config) == {"is_true": ["numeric_keypad"], "among": {"cpu_voltage_type": ["h"]}, "differs": {"gpu_type": "dedicated"}, "equals": {"brand": "B"}} and browse.pills(config)[0] == "键盘 · 是"
    rows = spark.createDataFrame([(True, "h", None, "B"), (True, "h", "dedicated", "B"), (None, "h", "x", "B")], "numeric_keypad boolean, cpu_voltage_type string, gpu_type string, brand string")
    assert browse.browse(rows, browse.forced(config)).count() == 1
    assert [r[0] for r in browse.facet(spark.createDataFrame([("微星",), ("华硕",), ("Dell",), (None,), ("华硕",)], "b string"), "b").collect()] == ["华硕", "微星", "Dell"]


def test_payloads_fail_soft_or_strictly(spark, tmp_path):
    def at(text):
        (tmp_path / "p.json").write_text(text)
        return f"file://{tmp_path}/p.json"

    assert payload.read_payload(spark, at('{"x": 1}'), strict=False).count() == 0 and payload.read_optional(spark, at("")) is None and payload.read_optional(spark, f"file://{tmp_path}/none") is None
    rows, shape = payload.read_rows(spark, at('{"data": [{"a": 1}, {"b": 2}]}'))
    assert rows.count() == 2 and shape == "data" and payload.read_rows(spark, at('[{"a": 1}]'))[1] == "list"
    for bad in ('{"rows": []}', "[]", '[{"a": 1}, 2]', "{"):
        with pytest.raises(payload.PayloadError):
            payload.read_rows(spark, at(bad))
    schema = "series string, numeric_keypad boolean"
    assert payload.read_facts(spark, at('[{"series": "s", "numeric_keypad": true}]'), schema).first()["numeric_keypad"] is True and payload.read_facts(spark, at("{bad"), schema).count() == 0 and payload.read_facts(spark, f"file://{tmp_path}/no", schema).count() == 0
    strict = {'{"note": "value was NaN"}': True, '{"sku": "a7e5000"}': True, '{"a": NaN}': False, '{"a": 1e999}': False, '{"a": 1, "a": 2}': False, '{"a": "x\\"NaN"}': True, '[1.5e3]': True, "": False}
    assert {x: bool(one(spark, x, payload.strict_json)) for x in strict} == strict


def test_capacities_and_compatible_forms(spark):
    assert [one(spark, x, T.capacity_gb) for x in ("1.5TB", "512GB + 1 tb", "１６ＧＢ", "16.9GB", "none", None)] == [1536, 1024, 16, 16, None, None]
    assert one(spark, "ＡＢ①㎏ﬁ（½）　x", T.compatible) == "AB1kgfi(1⁄2) x" and one(spark, "plain", T.compatible) == "plain" and one(spark, None, T.compatible) is None


def test_texts_are_redacted_completed_and_bound(spark):
    assert one(spark, "https://u:p@h.example/a?token=1", T.redacted_url) == "https://u:p@h.example/***" and one(spark, "x", T.redacted_url) == "<invalid-url>"
    assert one(spark, "ss://" + "A" * 30 + " http://me:pw@h/x", T.redacted_log) == "ss:*** http://***@h/x"
    full = lambda t: tuple(one(spark, t, lambda c: T.with_defaults(c, {"patch": "", "confidence": 0.0}, {"patch": "?"})))
    assert [full(t) for t in ('{"patch": "d", "confidence": "0.5"}', '{"confidence": "x"}', "{")] == [("d", 0.5), ("", 0.0), ("?", 0.0)]
    assert json.loads(one(spark, '{"a": null, "b": {"c": null, "d": [1, null, {"e": null}]}}', T.without_nulls)) == {"b": {"d": [1, None, {}]}}
    m = one(spark, "prompt", T.request_manifest)
    assert len(m["prompt_sha256"]) == 64 and m["request_id"] == m["prompt_sha256"][:16] and one(spark, " Ａ \n b", T.clean_text) == "A b"
    from urllib.parse import urljoin

    from attesta.functions import listings as L

    base = "https://h.example/a/b/c.html?q=1"
    for link in ("../x", "./y", "?p=2", "#top", "z/../w", "//o/x", "/r", "http://k/", "v.html", "", "../../../u"):
        assert one(spark, link, lambda c: L.absolute_url(base, c)) == urljoin(base, link), link
    assert [one(spark, n, L.single_source, "int") for n in (0, None, 1, 2)] == [True, True, True, False]


def test_yaml_subscriptions(spark):
    from attesta.functions import nodes
    from attesta.sources import http

    text = """
port: 7890
proxies:
  - {name: "a, b", type: ss, server: h1, port: 443, opts: {x: 1, y: [p, q]}, password: 'it''s'}
  - name: c
    type: vmess
    server: h2
    port: 80
    ws-opts:
      path: /x
      headers:
        Host: h3
    alpn:
      - h2
      - h3
    tls: true
  # a comment
  - name: broken
    type: ss
rules:
  - MATCH,DIRECT
"""
    got = [json.loads(x) for x in one(spark, text, nodes.yaml_nodes)]
    assert got[0] == {"name": "a, b", "type": "ss", "server": "h1", "port": 443, "opts": {"x": 1, "y": ["p", "q"]}, "password": "it's"}
    assert got[1] == {"name": "c", "type": "vmess", "server": "h2", "port": 80, "ws-opts": {"path": "/x", "headers": {"Host": "h3"}}, "alpn": ["h2", "h3"], "tls": True}
    parsed = [one(spark, json.dumps(x), nodes.yaml_node) for x in got]
    assert (parsed[1]["name"], parsed[1]["port"], parsed[1]["opts"]["tls"]) == ("c", 80, "true") and parsed[2] is None
    assert one(spark, "vmess://x", nodes.yaml_nodes) is None and one(spark, "proxies:", nodes.yaml_nodes) == [] and one(spark, None, nodes.yaml_nodes) is None
    chain = {"u1": "http://u2", "http://u2": " http://u3\n", "http://u3": "ss://x", "loop": "http://loop", "http://loop": "http://loop"}
    get = lambda u: (200, chain[u], u, None) if u in chain else (None, None, u, "x")
    assert http.subscription("u1", get) == "ss://x" and http.subscription("loop", get) == "" and http.subscription("gone", get) == ""
    listed = {1: [1] * 3, 2: [1] * 3, 3: [1]}
    assert len(http.paged("p{page}", lambda u: (200, json.dumps(listed[int(u[1:])]), u, None), 3)) == 7
    pool_, new = spark.createDataFrame([("a",)], "name string"), spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("ad x", 4)], "name string, o int")
    taken, counts = pool.subscribed(pool_, new, "name", "o", ["AD"])
    assert [r["name"] for r in taken.collect()] == ["b"] and tuple(counts.first()) == (1, 1, 2)


def test_cursors_and_upserts(spark, tmp_path):
    from attesta.operators import protect, reports, validate
    from attesta.streaming import incremental

    schema = "k string, side int, items array<string>, skipped map<string,string>, brand_index int, page int, plan array<string>, complete boolean, total int"
    rows = [("a", 0, ["x", "y"], {"s": "old", "t": "1"}, 2, 1, ["p", "q"], True, 5), ("a", 1, ["z"], None, 1, 9, ["p", "q"], True, None), ("a", 2, ["y"], {"s": "new"}, None, None, None, True, 3), ("b", 0, None, None, 1, 1, ["p"], True, None), ("b", 2, ["v"], None, 3, 3, ["q"], None, None)]
    out = {r["k"]: r for r in reports.merge_bundles(spark.createDataFrame(rows, schema), "k").collect()}
    assert (out["a"]["items"], out["a"]["skipped"], out["a"]["brand_index"], out["a"]["page"], out["a"]["complete"], out["a"]["total"]) == (["y", "z", "x"], {"s": "new", "t": "1"}, 1, 9, True, 5)
    assert (out["b"]["brand_index"], out["b"]["page"], out["b"]["complete"], out["b"]["total"]) == (0, 1, False, 1)
    top = reports.most_common(spark.createDataFrame([("b", 0), ("a", 1), ("a", 2), ("b", 3), ("c", 4)], "v string, o int"), F.col("v"), "v", "o", 2)
    assert [tuple(r) for r in top.collect()] == [("b", 2), ("a", 2)]
    df = spark.createDataFrame([("k1", 1, "x"), ("k1", 2, "y"), ("k2", 3, "z")], "k string, o int, v string")
    sink = incremental.upsert_sink(spark, f"file://{tmp_path}/state", "k", "o")
    sink(df, 0)
    sink(df.where("o = 2").withColumn("v", F.lit("new")), 1)
    sink(df.where("o = 2").withColumn("v", F.lit("new")), 1)
    assert sorted((r["k"], r["v"]) for r in incremental.read_newest(spark, f"file://{tmp_path}/state", "k").collect()) == [("k1", "new"), ("k2", "z")] and incremental.read_newest(spark, f"file://{tmp_path}/none", "k") is None
    with pytest.raises(PublishGuardError):
        protect.guarded_write(df, f"file://{tmp_path}/few", 4, "the scan")
    protect.guarded_write(df, f"file://{tmp_path}/few", 3, "the scan")
    assert spark.read.json(f"file://{tmp_path}/few").count() == 3
    (tmp_path / "l1").write_text("one")
    (tmp_path / "l2").write_text("two")
    assert payload.joined(payload.read_logs(spark, [f"file://{tmp_path}/{n}" for n in ("l2", "gone", "l1")])).first()["text"] == "two\none" and len(payload.file_digests(spark, f"file://{tmp_path}/l1").first()["sha256"]) == 64
    assert one(spark, "A\\.GIT\\x.py", lambda c: validate.skipped(c, [r"\.git/"])) is True and one(spark, "a/b.py", lambda c: validate.skipped(c, [r"\.git/"])) is False


def test_details_of_three_sources(spark):
    specs = {"CPU型号": "Intel 酷睿 i9-13900HX", "键盘": "背光键盘 带数字小键盘", "显卡型号": "RTX 4060", "内存容量": "32GB", "固态硬盘": "2TB", "硬盘容量": "1TB", "USB接口": "3个", "数据接口": "USB", "产品净重": "2.5kg", "重量": "2.4kg", "产品类型": "游戏本", "电池容量": "80Wh"}
    rows = [(1, "m 16G 512G", "https://detail.zol.com.cn/notebook/index2165921.shtml"), (2, "m 16G 512G", "b"), (3, "m 16G 512G", "c"), (4, "m 16G 512G", "d")]
    items = spark.createDataFrame(rows, "i int, title string, spec_url string")
    pages = spark.createDataFrame([(rows[0][2], specs, None, False, None), ("b", None, None, True, None), ("c", {}, None, False, None), ("d", {"内存容量": "8GB"}, None, False, "机身 背光键盘 好")], "url string, specs map<string,string>, error string, risk boolean, page_text string")
    jd = {r["i"]: r for r in scan.assembled(scan.with_details(items, pages, source="JD"), "JD").collect()}
    assert [jd[i]["crawl_warning"] for i in (1, 2, 3, 4)] == [None, "detail_risk_verification", "detail_specs_unavailable", None]
    a = jd[1]
    assert (a["cpu"], a["numeric_keypad"], a["keyboard_backlight"], a["gpu_type"], a["memory_gb"], a["storage_gb"], a["weight_kg"], a["battery_wh"], a["product_form"]) == ("i9-13900HX", True, True, "dedicated", 32, 2048, 2.5, 80.0, "游戏本")
    assert sorted(a["ports"]) == ["USB接口: 3个", "数据接口: USB"] and jd[2]["memory_gb"] == 16 and jd[4]["keyboard_backlight"] is True and jd[4]["memory_gb"] == 8 and jd[4]["product_form"] == "m 16G 512G"
    pc = {r["i"]: r for r in scan.assembled(scan.with_details(items, pages.drop("risk", "page_text"), source="PConline"), "PConline").collect()}
    assert pc[1]["storage_gb"] == 1024 and pc[1]["weight_kg"] == 2.4 and "CPU型号：Intel" in pc[1]["evidence"]["numeric_keypad"] and pc[4]["evidence"]["numeric_keypad"] == ""
    assert [r[0] for r in items.coalesce(1).select(scan.detail_page("ZOL", F.col("spec_url"))).collect()] == ["https://detail.zol.com.cn/2166/2165921/param.shtml", None, None, None]
    assert one(spark, "https://h/1.html", lambda c: scan.detail_page("PConline", c)) == "https://h/1_detail.html" and one(spark, "https://h/1_detail.html", lambda c: scan.detail_page("PConline", c)) == "https://h/1_detail.html"


def test_product_lines_and_listing_filters(spark):
    def plain(model, title, brand):
        m = str(model or title or "")
        base = m.replace("(", "（").split("（")[0].strip()
        if base == m and len(base) > 18:
            cut = base[:18]
            sp = max(cut.rfind(c) for c in " ·-【")
            base = cut[:sp].strip() if sp > 4 else cut.strip()
        return f"spu|{(brand or '').strip()}|{''.join(base.split())}", base or m, (brand or "").strip()

    rows = [("联想 Y7000P（16GB）", None, "联想"), ("", "a long title of many words", None), ("abcd efghijklmnopqrstuvwxyz", "t", " b "), ("abcde-fghijklmnopqrstuvwxyz", "t", "b"), ("【自营】惠普·暗影精灵10 16英寸 游戏本电脑", "", "惠普"), ("short", None, None), (None, None, None), ("x" * 40, None, None)]
    df = spark.createDataFrame(rows, "m string, t string, b string").coalesce(1)
    assert [tuple(r[0]) for r in df.select(browse.product_line(F.col("m"), F.col("t"), F.col("b"))).collect()] == [plain(*r) for r in rows]
    spec = browse.listing_spec({"search": " Y7 ", "hideDedicated": True, "brand": "", "memoryMin": 16, "priceMax": 9000, "numpadOnly": True, "multiOnly": False})
    assert spec == {"search": (["title", "model", "cpu", "gpu", "brand"], " Y7 "), "least": {"memory_gb": 16}, "most": {"price": 9000}, "is_true": ["numeric_keypad"], "not_true": ["dedicated_gpu"]}


def test_streaks_across_stretches(spark):
    import random

    rng = random.Random(1)
    rows = [(p, o, rng.random() < q) for p, q in enumerate([0.5, 0.9, 0.99, 1, 0]) for o in rng.sample(range(3000), 200)]
    want = {}
    for p in range(5):
        best = run = 0
        for _, _, f in sorted(r for r in rows if r[0] == p):
            run = run + 1 if f else 0
            best = max(best, run)
        want[p] = best
    df = spark.createDataFrame(rows, "p int, o int, f boolean")
    for ranges in ("1", "3", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", ranges)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert dict(map(tuple, resolve.streaks(df, "p", "o", F.col("f")).collect())) == want
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
