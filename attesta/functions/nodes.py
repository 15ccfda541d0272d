"""Proxy node links and subscriptions as column expressions: one struct<name, type, server, port, opts> a link, null where it is broken."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import empty_to_null, let

AUTHORITY = r"^[A-Za-z0-9+.\-]+://(?:([^/?#]*)@)?(\[[^\]/?#]*\]|[^:/?#@]*)(?::(\d+))?(?:[/?#]|$)"


def base64_text(text: Column) -> Column:
    """The UTF-8 text of a base64 text whose padding may be missing; null if it is none."""
    t = F.regexp_replace(text, r"\s+", "")
    t = F.rpad(t, (F.ceil(F.length(t) / 4) * 4).cast("int"), F.lit("="))
    return F.try_validate_utf8(F.try_to_binary(t, F.lit("base64")).cast("string"))


def unquoted(text: Column) -> Column:
    """Percent escapes decoded; a plus sign stays."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def query_pairs(query: Column) -> Column:
    """The parameters of a query in order as array<struct<k, v>>, decoded."""
    parts = F.filter(F.split(F.coalesce(query, F.lit("")), "&"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(F.try_url_decode(F.regexp_extract(p, "^([^=]*)", 1)).alias("k"), F.try_url_decode(F.regexp_extract(p, "^[^=]*=(.*)$", 1)).alias("v")))


def first_of(pairs: Column, *names: str, default: Column | str | None = None) -> Column:
    """The first value that is not blank, under the first name that has one."""
    def named(name: str) -> Column:
        return F.get(F.filter(pairs, lambda p: (p["k"] == name) & (p["v"] != "")), F.lit(0))["v"]

    end = [default if isinstance(default, Column) else F.lit(default)] if default is not None else []
    return F.coalesce(*map(named, names), *end)


def reality_short_id(value: Column) -> Column:
    """Whether a value is an even number, up to 16, of hex digits."""
    return F.trim(value).rlike(r"^(?:[0-9a-fA-F]{2}){1,8}$")


class _Link:
    """The pieces of a URL-shaped link."""

    def __init__(self, link: Column):
        part = lambda k: empty_to_null(F.regexp_extract(link, AUTHORITY, k))
        self.user = empty_to_null(F.regexp_extract(F.coalesce(part(1), F.lit("")), "^([^:]*)", 1))
        self.password = empty_to_null(F.regexp_extract(F.coalesce(part(1), F.lit("")), "^[^:]*:(.*)$", 1))
        self.server = F.lower(F.regexp_replace(part(2), r"^\[|\]$", ""))
        self.port = part(3).try_cast("int")
        self.q = query_pairs(F.regexp_extract(link, r"^[^?#]*\?([^#]*)", 1))
        self.fragment = empty_to_null(unquoted(F.regexp_extract(link, "^[^#]*#(.*)$", 1)))

    def get(self, *names: str, default: Column | str | None = None) -> Column:
        return first_of(self.q, *names, default=default)


def _node(name: Column, kind: str, server: Column, port: Column, **opts: Column | str | bool | None) -> Column:
    entries = []
    for k, v in opts.items():
        c = v if isinstance(v, Column) else F.lit({True: "true", False: "false"}.get(v, v) if isinstance(v, bool) else v)
        entries += [F.lit(k.replace("__", ".").replace("_", "-")), c.cast("string")]
    options = F.map_filter(F.create_map(*entries), lambda k, v: v.isNotNull())
    return F.struct(F.coalesce(name, F.lit(kind)).alias("name"), F.lit(kind).alias("type"), server.alias("server"), port.cast("int").alias("port"), options.alias("opts"))


def _transport(network: Column, path: Column, host: Column | None, service: Column) -> dict[str, Column]:
    out = {"network": F.when(network.isin("ws", "grpc"), network), "ws_opts__path": F.when(network == "ws", path), "grpc_opts__grpc_service_name": F.when(network == "grpc", service)}
    if host is not None:
        out["ws_opts__headers__Host"] = F.when(network == "ws", host)
    return out


def vmess(link: Column) -> Column:
    j = base64_text(F.substr(link, F.lit(9)))
    raw = lambda k: F.get_json_object(j, f"$.{k}")
    or_ = lambda k, d: F.coalesce(raw(k), F.lit(d))
    host = F.coalesce(empty_to_null(raw("host")), raw("add"))
    port, aid = F.trim(or_("port", "443")).try_cast("int"), F.trim(or_("aid", "0")).try_cast("int")
    tls = raw("tls") == "tls"
    node = _node(empty_to_null(raw("ps")), "vmess", raw("add"), port, uuid=raw("id"), alterId=aid, cipher=or_("scy", "auto"), udp=True,
                 **_transport(or_("net", "tcp"), or_("path", "/"), host, or_("path", "")), tls=F.when(tls, "true"), servername=F.when(tls, F.coalesce(empty_to_null(raw("sni")), host)))
    return F.when(j.rlike(r"^\s*\{") & F.try_parse_json(j).isNotNull() & port.isNotNull() & aid.isNotNull(), node)


def vless(link: Column) -> Column:
    u = _Link(link)
    security, network = u.get("security"), u.get("type", default="tcp")
    reality = security == "reality"
    sid = u.get("sid", "short-id")
    return _node(u.fragment, "vless", u.server, u.port, uuid=u.user, udp=True, flow=u.get("flow"), encryption=F.coalesce(u.get("encryption"), F.when(reality, "none")),
                 tls=F.when(security.isin("tls", "reality"), "true"), servername=F.when(security.isin("tls", "reality"), u.get("sni", "host")), client_fingerprint=u.get("fp", "client-fingerprint"),
                 reality_opts__public_key=F.when(reality, u.get("pbk", "public-key")), reality_opts__short_id=F.when(reality & reality_short_id(sid), F.trim(sid)),
                 reality_opts__spider_x=F.when(reality, u.get("spx", "spider-x", "spiderx")), **_transport(network, u.get("path", default="/"), u.get("host", default=u.server), u.get("serviceName", default="")))


def trojan(link: Column) -> Column:
    u = _Link(link)
    return _node(u.fragment, "trojan", u.server, u.port, password=u.user, udp=True, sni=u.get("sni"), **_transport(u.get("type", default="tcp"), u.get("path", default="/"), None, u.get("serviceName", default="")))


def shadowsocks(link: Column) -> Column:
    body = F.regexp_extract(F.substr(link, F.lit(6)), "^([^#]*)", 1)
    decoded = F.when(body.contains("@"), body).otherwise(base64_text(body))
    user, at = F.regexp_extract(decoded, "^(.*)@[^@]*$", 1), F.regexp_extract(decoded, "^.*@([^@]*)$", 1)
    user = F.when(body.contains("@"), F.coalesce(base64_text(user), unquoted(user))).otherwise(user)
    port = F.regexp_extract(at, r"^.*:(\d+)/?$", 1).try_cast("int")
    node = _node(empty_to_null(unquoted(F.regexp_extract(link, "^[^#]*#(.*)$", 1))), "ss", F.regexp_replace(F.regexp_extract(at, "^(.*):[^:]*$", 1), r"^[\[\]]+|[\[\]]+$", ""), port,
                 cipher=F.regexp_extract(user, "^([^:]*):", 1), password=F.regexp_extract(user, "^[^:]*:(.*)$", 1), udp=True)
    return F.when(port.isNotNull() & user.contains(":"), node)


def shadowsocksr(link: Column) -> Column:
    d = base64_text(F.substr(link, F.lit(7)))
    p = F.split(d, ":", 6)
    at = lambda i: F.get(p, F.lit(i))
    remarks = first_of(query_pairs(F.regexp_extract(at(5), r"/\?(.*)$", 1)), "remarks")
    name, password, port = base64_text(remarks), base64_text(F.regexp_extract(at(5), r"^(.*?)(?:/\?.*)?$", 1)), at(1).try_cast("int")
    node = _node(name, "ssr", at(0), port, cipher=at(3), password=password, protocol=at(2), obfs=at(4), udp=True)
    return F.when((F.size(p) == 6) & port.isNotNull() & password.isNotNull() & (remarks.isNull() | name.isNotNull()), node)


def hysteria(link: Column) -> Column:
    u = _Link(link)
    return _node(u.fragment, "hysteria", u.server, u.port, password=F.coalesce(u.user, u.get("auth", default="")), obfs=u.get("obfs"), alpn=u.get("alpn", default="h3"),
                 protocol=u.get("protocol", default="udp"), up=u.get("up", default="20 Mbps"), down=u.get("down", default="100 Mbps"), sni=u.get("sni", default=u.server),
                 skip_cert_verify=u.get("insecure", default="0") == "1")


def hysteria2(link: Column) -> Column:
    u = _Link(link)
    obfs = u.get("obfs")
    return _node(u.fragment, "hysteria2", u.server, u.port, password=F.coalesce(u.user, u.get("auth", default="")), sni=u.get("sni"), obfs=obfs,
                 obfs_password=F.when(obfs.isNotNull(), u.get("obfs-password", default="")))


def tuic(link: Column) -> Column:
    u = _Link(link)
    return _node(u.fragment, "tuic", u.server, u.port, uuid=u.user, password=u.password, alpn="h3", congestion_controller=u.get("congestion_control", "congestion-controller", default="cubic"),
                 sni=u.get("sni", default=u.server), disable_sni=u.get("disable_sni", default="0") == "1", reduce_rtt=u.get("reduce_rtt", default="1") == "1",
                 udp_relay_mode=u.get("udp_relay_mode", default="native"))


def wireguard(link: Column) -> Column:
    u = _Link(link)
    mtu = u.get("mtu", default="1280").try_cast("int")
    node = _node(u.fragment, "wireguard", u.server, u.port, private_key=u.user, ip=u.get("ip", default=""), ipv6=u.get("ipv6", default=""), public_key=u.get("publickey", "public-key", default=""),
                 dns=u.get("dns", default=""), mtu=mtu, udp=True)
    return F.when(mtu.isNotNull(), node)


SCHEMES = {
    "vmess": vmess, "vless": vless, "trojan": trojan, "ss": shadowsocks, "ssr": shadowsocksr, "hysteria": hysteria, "hysteria2": hysteria2, "hy2": hysteria2,
    "tuic": tuic, "wireguard": wireguard,
}


def parse_node(link: Column, schemes: tuple[str, ...] = tuple(SCHEMES)) -> Column:
    """The node of a link of any of the schemes; null for others and for broken ones."""
    node = lambda t: F.coalesce(*(F.when(t.startswith(f"{s}://"), SCHEMES[s](t)) for s in schemes))
    return let(let(F.trim(link), node), lambda n: F.when(F.coalesce(n["server"], F.lit("")) != "", n))


def subscription_links(body: Column) -> Column:
    """The links of a subscription: a plain list, or the base64 of one."""
    text = F.when(body.contains("://"), body).otherwise(F.coalesce(base64_text(body), body))
    return F.filter(F.transform(F.split(text, r"\r?\n"), lambda x: F.trim(x)), lambda x: x.contains("://"))


def _scalar(text: str):
    t = text.strip()
    if len(t) > 1 and t[0] == t[-1] and t[0] in "\"'":
        return t[1:-1].replace("''", "'") if t[0] == "'" else json.loads(t)
    if t in ("true", "false"):
        return t == "true"
    return None if t in ("", "~", "null") else int(t) if re.fullmatch(r"-?\d+", t) else float(t) if re.fullmatch(r"-?\d+\.\d+", t) else t


def _flow(text: str):
    """A value in flow style: maps and lists in brackets, or a scalar."""
    t = text.strip()
    if not t or t[0] not in "{[":
        return _scalar(t)
    parts, depth, quote, begun = [], 0, "", 0
    for i, c in enumerate(t[1:-1]):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c in "{[":
            depth += 1
        elif c in "}]":
            depth -= 1
        elif c == "," and not depth:
            parts.append(t[1:-1][begun:i])
            begun = i + 1
    parts = [p for p in (*parts, t[1:-1][begun:]) if p.strip()]
    if t[0] == "[":
        return [_flow(p) for p in parts]
    return {str(_scalar(k)): _flow(v) for k, _, v in (p.partition(":") for p in parts)}


def _block(lines: list[tuple[int, str]], at: int, indent: int):
    """The block value whose lines begin at ``at`` with this indentation, and the line behind it: a list of items, or a map."""
    as_list = lines[at][1].startswith("- ") or lines[at][1] == "-"
    out = [] if as_list else {}
    while at < len(lines) and lines[at][0] == indent and (lines[at][1].startswith("-") == as_list):
        text = lines[at][1]
        if as_list:
            inner = text[1:].lstrip()
            if inner[:1] in ("{", "[") or not re.match(r"[^\s:\"']+:(?:\s|$)", inner):
                out.append(_flow(inner))
                at += 1
            else:  # a map that begins beside its dash
                deep = indent + len(text) - len(inner)
                value, at = _block([*lines[:at], (deep, inner), *lines[at + 1 :]], at, deep)
                out.append(value)
            continue
        key, _, rest = text.partition(":")
        at += 1
        if rest.strip():
            out[str(_scalar(key))] = _flow(rest)
        elif at < len(lines) and (lines[at][0] > indent or lines[at][0] == indent and lines[at][1].startswith("-")):
            out[str(_scalar(key))], at = _block(lines, at, lines[at][0])
        else:
            out[str(_scalar(key))] = None
    return out, at


def yaml_nodes(body: Column) -> Column:
    """The nodes of a YAML subscription's ``proxies`` list as JSON objects: block and flow style, as such lists are written; null where there is none."""

    def read(text: str | None) -> list[str] | None:
        lines = [(len(x) - len(x.lstrip(" ")), x.strip()) for x in (text or "").splitlines() if x.strip() and not x.lstrip().startswith("#")]
        start = next((i for i, (n, x) in enumerate(lines) if not n and x.startswith("proxies:")), None)
        if start is None:
            return None
        try:
            if lines[start][1] != "proxies:":
                found = _flow(lines[start][1].partition(":")[2])
            else:
                found = _block(lines, start + 1, lines[start + 1][0])[0] if start + 1 < len(lines) else []
        except (IndexError, ValueError):
            return None
        return [json.dumps(p, ensure_ascii=False) for p in found if isinstance(p, dict)] if isinstance(found, list) else None

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(read)

    return run(body)


def yaml_node(node: Column) -> Column:
    """A node of a YAML subscription as the same struct that links give; null without a name, server or port."""
    get = lambda n: F.get_json_object(node, f"$.{n}")
    options = F.map_filter(F.from_json(node, "map<string,string>"), lambda k, v: ~k.isin("name", "type", "server", "port") & v.isNotNull())
    port = get("port").try_cast("int")
    made = F.struct(get("name").alias("name"), get("type").alias("type"), get("server").alias("server"), port.alias("port"), options.alias("opts"))
    return F.when(empty_to_null(get("name")).isNotNull() & empty_to_null(get("server")).isNotNull() & port.isNotNull(), made)


def secret_urls(raw: Column) -> Column:
    """The different http and https addresses in a secret: a JSON list, text or object of them, or a list with commas, semicolons or white space."""
    as_list = F.when(raw.rlike(r"^\s*\["), F.from_json(raw, "array<string>")).when(raw.rlike(r"^\s*\{"), F.map_values(F.from_json(raw, "map<string,string>"))).when(raw.rlike('^\\s*"'), F.array(F.get_json_object(F.concat(F.lit('{"x":'), raw, F.lit("}")), "$.x")))
    items = F.transform(F.coalesce(as_list, F.split(raw, r"[\s,;]+")), lambda x: F.trim(x))
    return F.array_distinct(F.filter(items, lambda x: x.rlike(r"^https?://[^/\s]+")))


def excluded(name: Column, keywords: list[str]) -> Column:
    """Whether a name contains any of the keywords, in any case."""
    return F.exists(F.array(*map(F.lit, keywords)).cast("array<string>"), lambda k: F.lower(name).contains(F.lower(k)))


def render_url(kind: Column, host: Column, port: Column, user: Column, password: Column) -> Column:
    """A proxy's address; socks5 for SOCKS kinds, http for the rest, with a name and password where there is a name."""
    scheme = F.when(F.lower(kind).startswith("socks"), "socks5").otherwise("http")
    auth = F.when(F.coalesce(user, F.lit("")) != "", F.concat(user, F.lit(":"), F.coalesce(password, F.lit("")), F.lit("@"))).otherwise("")
    return F.concat(scheme, F.lit("://"), auth, host, F.lit(":"), port.cast("string"))
