import base64
import io
import json
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, HTTPServer

from pyspark.sql import functions as F

from attesta.functions import listings as L
from attesta.functions import nodes as N
from attesta.operators import pool
from attesta.sources import archives, http, markup


def run(spark, rows, f, schema="x string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r[0] for r in df.coalesce(1).select(f(*map(F.col, df.columns))).collect()]


def test_processors(spark):
    assert run(spark, ["Intel 酷睿 i7-13650HX 笔记本", "Ultra 7 155H", "锐龙 7 7840U", "i9-14900K", "R9 7950X3D", "N100", None], L.cpu_model) == ["i7-13650HX", "Ultra 7 155H", "锐龙 7 7840U", "i9-14900K", "R9 7950X3D", "N100", ""]
    assert run(spark, ["i7-13650HX", "i5-1340P", "Ultra 7 155H", "i7-1165G7", "锐龙 7 7840U", "i9-14900K", "i9-13980HK", None], L.cpu_voltage) == ["high_performance", "unknown", "standard_performance", "low_power", "low_power", "desktop_performance", "high_performance", "unknown"]
    same = [("酷睿i7 13650HX", None, None), ("", "", "Intel Core i7-13650HX"), ("锐龙R9 7945HX", "", ""), ("Ultra 9 185H", "", "")]
    assert run(spark, same, L.cpu_identity, "a string, b string, c string") == ["intel-i7-13650hx", "intel-i7-13650hx", "amd-r9-7945hx", "intel-ultra9-185h"]
    assert [tuple(r) for r in run(spark, ["Intel Core Ultra 7", "AMD 锐龙 5 7535HS", "N100"], L.cpu_fields)] == [("Intel", "Ultra 7"), ("AMD", "锐龙 5"), ("", "")]


def test_flags_and_graphics(spark):
    assert [tuple(r) for r in run(spark, ["带数字小键盘，RGB背光", "无数字键盘，背光键盘", "轻薄", None], L.keyboard_flags)] == [(True, True), (False, True), (None, None), (None, None)]
    assert [tuple(r) for r in run(spark, ["无数字键盘", "no backlight, no keypad", "Backlit numpad"], L.fact_flags)] == [(True, None), (False, True), (True, True)]
    assert [tuple(r) for r in run(spark, [("", "RTX 4060"), ("集成显卡", ""), ("", "x")], L.gpu_fields, "a string, b string")] == [("dedicated", True), ("integrated", False), ("unknown", None)]


def test_titles(spark):
    assert run(spark, ["【限时】联想（Lenovo）拯救者Y7000P 13代酷睿i7-13650HX 16G 1T", "16GB", "华硕(ASUS)天选5 Pro 15.6英寸"], L.model_of_title) == ["拯救者Y7000P", "16GB", "天选5 Pro"]
    assert run(spark, ["暗影精灵 Pro 16酷睿版", "星 Book 14英寸", None], L.normal_series) == ["暗影精灵", "星book", ""]
    assert run(spark, ["惠普 OMEN 暗影精灵10 游戏本", "HP 战66 七代"], L.series) == ["暗影精灵10", "战66"]
    assert run(spark, ["屏幕 15.6英寸", "容量 100英寸 16 Pro", "无"], L.screen_of_title) == ["15.6英寸", "16英寸", ""]
    f = run(spark, ["天选 i7-13650HX/16GB/1TB/RTX4060 15.6英寸"], L.title_fields)[0]
    assert (f["cpu"], f["gpu"], f["screen_size"], f["memory_gb"], f["storage_gb"]) == ("i7-13650HX", "RTX4060", 15.6, 16, 1024)
    f = run(spark, ["天选 16G 1T 2.1kg"], lambda c: L.title_fields(c, loose=True))[0]
    assert (f["memory_gb"], f["storage_gb"], f["weight_kg"]) == (16, 1024, 2.1)
    assert run(spark, ["Lenovo Y7000", "新机 A1"], L.brand_of_title) == ["联想", "新机"]
    assert run(spark, ["zol 中关村在线", "J_D", "other", ""], L.source_name) == ["ZOL", "JD", "OTHER", "UNKNOWN"]
    assert run(spark, ["//a/b", "/c", "https://x/y", "d", ""], lambda c: L.absolute_url("https://h/p/q", c)) == ["https://a/b", "https://h/c", "https://x/y", "https://h/p/d", "https://h/p/q"]


def test_identity_joins_sources_and_keeps_families_apart(spark):
    schema = "b string, m string, t string, c string, s array<string>, i string"
    rows = [("联想", "联想拯救者Y7000P（i7 13650HX/16GB/512GB/RTX4060）", "", "i7 13650HX", ["ZOL"], None),
            ("Lenovo", "", "联想（Lenovo）拯救者Y7000P 13代酷睿i7-13650HX 16G 1T", "i7-13650HX", ["JD"], None),
            ("联想", "联想拯救者Y9000P（i7 13650HX）", "", "i7 13650HX", ["ZOL"], None),
            ("", "", "", "", [], None)]
    a, b, c, d = run(spark, rows, L.listing_key, schema)
    assert a == b != c and len(a) == 24 and d is None


def test_admission(spark):
    df = spark.createDataFrame([("是", "true", "i7-13650HX", "", ""), ("1", None, "i7-1165G7", "", ""), ("1", "1", "i9-14900K", "ZOL notebook", "CLEVO 模具"), ("1", "1", "i9-14900K", "ZOL notebook", "mini PC notebook")], "k string, b string, cpu string, cat string, form string")
    v = L.voltage(F.lit(""), F.col("cpu"), F.lit(""))
    empty = F.lit("")
    portable = L.portable_form(F.col("cat"), empty, empty, F.col("form"), F.create_map(F.lit("a"), F.lit("")))
    assert [r[0] for r in df.coalesce(1).select(L.admission_reasons(F.col("k"), F.col("b"), v, portable)).collect()] == [[], ["keyboard_backlight_not_confirmed", "cpu_voltage_not_allowed:low_power"], [], ["desktop_cpu_product_form_not_confirmed"]]
    assert run(spark, [("Ryzen 9 7950", "AM5 socket")], lambda c, e: L.voltage(F.lit(None).cast("string"), c, e), "c string, e string") == ["desktop_performance"]


def b64(x):
    return base64.b64encode(x.encode()).decode().rstrip("=")


def test_node_links(spark):
    links = [
        "vmess://" + b64(json.dumps({"ps": "n1", "add": "h.example", "port": "8443", "id": "u", "net": "ws", "tls": "tls", "path": "/p"})),
        "vless://u@H.example:443?security=reality&sni=s&pbk=k&sid=ab12&type=grpc&serviceName=g#a%20b",
        "trojan://pw@h:1?sni=x&type=ws", "ss://" + b64("aes:p:w") + "@[::1]:9#s", "ss://" + b64("aes:pw@h:9"),
        "ssr://" + b64(f"h:7:origin:aes:plain:{b64('pw')}/?remarks={b64('nm')}"), "hysteria://h:5?auth=z&insecure=1", "hy2://pw@h:6?obfs=o",
        "tuic://u:p@h:8", "wireguard://k@h:9?mtu=1400", "vmess://broken", "wireguard://k@h:9?mtu=x", "http://x", None,
    ]
    got = run(spark, links, N.parse_node)
    assert [g and (g["name"], g["type"], g["server"], g["port"]) for g in got] == [
        ("n1", "vmess", "h.example", 8443), ("a b", "vless", "h.example", 443), ("trojan", "trojan", "h", 1), ("s", "ss", "::1", 9), ("ss", "ss", "h", 9), ("nm", "ssr", "h", 7),
        ("hysteria", "hysteria", "h", 5), ("hysteria2", "hysteria2", "h", 6), ("tuic", "tuic", "h", 8), ("wireguard", "wireguard", "h", 9), None, None, None, None,
    ]
    assert got[0]["opts"]["servername"] == "h.example" and got[0]["opts"]["ws-opts.path"] == "/p"
    assert got[1]["opts"]["reality-opts.short-id"] == "ab12" and got[1]["opts"]["grpc-opts.grpc-service-name"] == "g" and got[1]["opts"]["encryption"] == "none"
    assert got[3]["opts"]["password"] == "p:w" and got[5]["opts"]["password"] == "pw" and got[6]["opts"]["skip-cert-verify"] == "true" and got[9]["opts"]["mtu"] == "1400"
    assert run(spark, [b64("trojan://a@b:1\nss://x\n"), "trojan://a@b:1\n\nnone"], N.subscription_links) == [["trojan://a@b:1", "ss://x"], ["trojan://a@b:1"]]
    assert run(spark, ['["http://a", "ftp://b", "http://a"]', "https://x; http://y", '{"k": "http://z"}', '"http://q"'], N.secret_urls) == [["http://a"], ["https://x", "http://y"], ["http://z"], ["http://q"]]
    assert run(spark, [("socks5", "h", "1", "u", "p"), ("http", "h", "2", "", "")], N.render_url, "a string, b string, c string, d string, e string") == ["socks5://u:p@h:1", "http://h:2"]


def test_pool(spark):
    nodes = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "node string, o int")
    log = spark.createDataFrame([("k", 1, "a", 0), ("k", 2, "b", 1), ("m", 1, "a", 5)], "key string, at int, node string, rows int")
    assert sorted(map(tuple, pool.failover(log, nodes, "key", "at", "node", "rows", "o").collect())) == [("k", "b", ["a", "b"], "c"), ("m", "a", [], None)]
    assert [r["node"] for r in pool.insert_new(nodes, spark.createDataFrame([("a", 1), ("d", 2), ("d", 3), ("Bad", 4)], "node string, o int"), "node", "o", ["bad"]).collect()] == ["d"]
    stats = spark.createDataFrame([("a", 1, 3, 1), ("b", 0, 0, 2), ("c", 9, 1, 3)], "node string, success int, fail int, o int")
    assert pool.best(stats, "node", "o").first()[0] == "c"
    h = spark.createDataFrame([("a", [5], 1), ("b", [9, 0], 2), ("c", [7, 3], 3), ("D", [1], 4), ("e", [], 5)], "node string, h array<int>, o int")
    assert pool.fastest(h, "node", "h", "o", ["D"]).first()[0] == "c"
    pages = spark.createDataFrame([("s", 1, False), ("s", 2, True), ("s", 3, False), ("t", 1, False)], "s string, p int, risk boolean")
    assert sorted((r["s"], r["p"]) for r in pool.prefix_until(pages, "s", "p", F.col("risk")).collect()) == [("s", 1), ("t", 1)]
    assert pool.distinct_nodes(spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("", 4), (None, 5)], "name string, o int"), "name", "o").count() == 3


def test_lists_and_specifications(spark):
    follow = '<ul id="J_PicMode"><li data-follow-id="p12"><a class="pic" href="/a.html"><img></a><h3><span class="title-black"><a href="/x.html">A &amp;  B</a></span></h3><b class="price-type">1,299</b><li data-follow-id="p13"><p>no link</p><li data-follow-id="p14"><a class=pic href=//h/y.html title="C"></a></ul>'
    sku = '<li class="sku-detail"><div class="p-price" data-skuid="77"><strong>￥99</strong></div><div class="p-name"><a href="//i/77.html" title="T">x</a></div><div class="p-merchant">Shop</div></li><li class="sku-detail"><div class="p-name"><a href="//i/88.html">y</a></div></li>'
    product = '<ul class="plist"><li><a href="/notebook/123456.html">N</a><i class="my-price">5</i></li></ul>'
    got = markup.ranked_cards(follow, 2, markup.LAYOUTS["follow"])
    assert [(c["source_rank"], c["source_product_id"], c["title"], c["href"], c["price"]) for c in got] == [(49, "12", "A & B", "/x.html", 1299.0), (51, "14", "C", "//h/y.html", None)]
    assert [(c["source_rank"], c["source_product_id"], c["title"], c["price"], c["merchant"]) for c in markup.ranked_cards(sku, 1, markup.LAYOUTS["sku"])] == [(1, "77", "T", 99.0, "Shop"), (2, "88", "y", None, "")]
    assert [(c["source_product_id"], c["price"]) for c in markup.ranked_cards(product, 1, markup.LAYOUTS["product"])] == [("123456", 5.0)]
    table = "<table><tr><th>CPU</th><td>i7 更多参数</td><tr><th>CPU</th><td>i9</td><tr><td>x</td></table>"
    assert markup.spec_pairs(table) == {"CPU": "i9"}
    assert markup.spec_pairs(table, "items", 32, last_wins=False) == {"CPU": "i7 更多参数"}
    assert markup.spec_pairs('<ul class="parameter2"><li>品牌：A：B</li></ul><div class="Ptable-item"><dl><dt>k</dt><dd>v</dd></dl></div>', "dl") == {"品牌": "A:B", "k": "v"}
    df = spark.createDataFrame([(1, follow), (2, None), (3, "")], "page_no int, html string")
    assert markup.read_cards(df, markup.LAYOUTS["follow"]).count() == 2
    assert markup.read_specs(df, "page_no").count() == 3
    assert markup.is_risk_page("<title>京东安全</title>", "u") and not markup.is_risk_page("<p>x", "u")


def record(i):
    return {"id": i, "型号": "m", "品牌": "b", "source": "PConline", "url": "https://product.pconline.com.cn/x", "上市时间": "2024年", "CPU型号": "c", "内存容量": "16", "存储容量": "1", "屏幕尺寸": "-"}


def zipped(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n, x in files:
            z.writestr(n, x)
    return out.getvalue()


def test_archives(spark, tmp_path):
    good = zipped([("json/1.json", json.dumps(record(1))), ("other/x", "y")])
    bad = {
        "outside": [("json/../1.json", "{}")], "named": [("json/a.json", "{}")], "id": [("json/1.json", json.dumps(record(2)))], "none": [("x", "y")], "broken": [("json/1.json", "{")], "deep": [("json/x/1.json", json.dumps(record(1)))],
        "latin": [("json/1.json", json.dumps(record(1), ensure_ascii=False).encode("gb18030"))], "few": [("json/1.json", json.dumps(record(1) | {"CPU型号": "无"}))], "old": [("json/1.json", json.dumps(record(1) | {"上市时间": "2019年"}))], "twice": [("json/1.json", json.dumps(record(1))), ("json\\1.json", json.dumps(record(1)))],
    }
    for n, files in bad.items():
        (tmp_path / f"{n}.bad").write_bytes(zipped(files))
    (tmp_path / "zip.bad").write_bytes(b"not a zip")
    (tmp_path / "good.bad").write_bytes(good)
    got = {x["path"].rsplit("/", 1)[1][:-4]: (x["member"], x["error"]) for x in archives.read_records(spark, f"{tmp_path}/*.bad").collect()}
    assert got.pop("good") == ("1.json", None) and set(got) == {*bad, "zip"} and all(m is None and e for m, e in got.values())
    assert got["outside"][1].endswith("leads outside") and got["none"][1] == "no records" and got["zip"][1] == "the archive cannot be read" and got["twice"][1] == "a name comes twice" and "fewer than 4" in got["few"][1] and "year" in got["old"][1]
    small = archives.LIMITS | {"members": 1}
    assert [x["error"] for x in archives.archive_faults(archives.members(spark, f"{tmp_path}/good.bad"), "json", small).collect()] == ["too many members"]
    assert archives.choose_member(["b.json", "x/latest.json", "a.json"]) == "x/latest.json" and archives.choose_member(["b.JSON", "a.json"]) == "a.json" and archives.choose_member(["a"]) is None
    for n, c in (("old.zip", good), ("new.zip", zipped([("json/a.json", "{}")]))):
        (tmp_path / n).write_bytes(c)
    r = archives.read_records(spark, f"{tmp_path}/*.zip")
    created = r.select("path").distinct().withColumn("created_at", F.when(F.col("path").endswith("new.zip"), "2024-02-01").otherwise("2024-01-01"))
    assert [x["member"] for x in archives.restore_newest(spark, r, created).collect()] == ["1.json"]
    assert sorted(x["member"] for x in archives.read_chosen(spark, f"{tmp_path}/*.zip").collect()) == ["json/1.json", "json/a.json"]
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "f").write_text("new")
    (tmp_path / "t").mkdir()
    archives.replace_folder(str(tmp_path / "s"), str(tmp_path / "t"))
    assert (tmp_path / "t" / "f").read_text() == "new" and not (tmp_path / "s").exists()


def test_http_source(spark):
    seen: dict[str, int] = {}

    class H(BaseHTTPRequestHandler):
        def do_GET(self):
            seen[self.path] = seen.get(self.path, 0) + 1
            code = 404 if "gone" in self.path else 503 if "busy" in self.path and seen[self.path] == 1 else 200
            self.send_response(code)
            self.end_headers()
            self.wfile.write("价".encode("gb18030"))

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), H)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    http.register(spark)
    df = spark.read.format("attesta_http").option("urls", json.dumps([f"{base}/{p}" for p in ("a", "busy", "gone")])).load()
    got = {r["url"].rsplit("/", 1)[1]: (r["status"], r["body"], r["error"]) for r in df.collect()}
    server.shutdown()
    assert got == {"a": (200, "价", None), "busy": (200, "价", None), "gone": (404, None, "HTTP 404")}
    pages = {1: [1] * 100, 2: [2]}
    assert len(http.paged("{page}", lambda u: (200, json.dumps({"n": 2, "x": pages[int(u)]}), u, None))) == 101


def test_cards_of_pages_against_a_plain_pattern(spark):
    import html
    import re
    from collections import Counter

    from attesta.plans import catalogue

    d = "/root/testdata/sf0.001"
    want = Counter()
    for r in spark.read.parquet(f"{d}/pages.parquet").collect():
        for nav in re.findall(r"<nav[^>]*>(.*?)</nav>", r["html"] or "", re.S):
            for href, said in re.findall(r'<li[^>]*>\s*<a[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', nav, re.S):
                if title := markup.folded(html.unescape(re.sub(r"<[^>]+>", "", said))):
                    want[(r["page_id"], html.unescape(href), title)] += 1
    got = Counter((r["page_no"], r["href"], r["title"]) for r in catalogue.list_cards(spark, d).collect())
    assert sum(want.values()) > 0 and got == want
