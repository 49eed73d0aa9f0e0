"""Secret scans: strong secrets by their form, weak ones by what stands near them.

Strong spans (`assign`, `access`, `hex`) are reported as they are. A long random-looking token, an
account name or an endpoint alone says little; such weak candidates are reported only if a part of
a complementary role lies within reach in the same scope (a block of lines between empty ones). One
part is not taken twice: a token in the path of a URL is not complemented by a URL, nor one that is
an account name by that name.
Parts and candidates meet by an interval join: both are dealt to windows of a document, what a
window holds is bounded by its width, so only few parts are ever held together.
"""

import hashlib
import re
from bisect import bisect_right
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.tasks import map_columns, read

#: Code points between a weak candidate and the part that supports it; also the width of a window.
REACH = 400

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

#: Weak candidates: kind, role, form. A random-looking token must mix cases and digits.
_WEAK = (
    ("weak_secret", "secret", re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")),
    ("weak_user", "identifier", re.compile(r"(?:user(?:name)?|login|account|client_?id)\x20?[:=]\x20?[\"']?([A-Za-z0-9_.@-]{3,})", re.I | re.A)),
    ("weak_endpoint", "endpoint", re.compile(r"(?:jdbc:[a-z]+|https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]{4,}")),
)
_ROLE = {"assign": "secret", "access": "identifier", "hex": "secret"}
#: Which roles support a weak candidate: a secret wants a name or a place, those want a secret. A
#: token in a URL behind its userinfo (`path`) is a part of a place, so it wants a name.
_SUPPORT = {"secret": ("identifier", "endpoint"), "path": ("identifier",), "identifier": ("secret", "path"), "endpoint": ("secret",)}
_USERINFO = re.compile(r"[^/]*//[^/?#]*@")
_BREAK = re.compile(r"\n[\x20\t\r]*\n")


def _mixed(token: str) -> bool:
    return any(c.isdigit() for c in token) and any(c.islower() for c in token) and any(c.isupper() for c in token)


def strong_spans(text: str) -> list[tuple[int, str, int]]:
    """`(start, kind, end)` by start, then kind as listed; code points."""
    found = [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1])))


def weak_spans(text: str, strong: list[tuple[int, str, int]]) -> list[tuple[int, str, int, str]]:
    """Weak candidates that overlap no strong span: `(start, kind, end, role)`."""
    starts = [s[0] for s in strong]
    reach, most = [], 0
    for s in strong:
        reach.append(most := max(most, s[2]))
    # Of each URL its start, the end of its userinfo (or its start) and its end.
    urls = [(m.start(), m.start() + (len(u[0]) if (u := _USERINFO.match(m[0])) else 0), m.end()) for m in _WEAK[2][2].finditer(text)]
    out = []
    for kind, role, form in _WEAK:
        for m in form.finditer(text):
            start, end = m.span(m.lastindex or 0)
            if kind == "weak_secret":
                k = bisect_right(urls, end - 1, key=lambda u: u[0])
                role = "path" if k and urls[k - 1][2] > start and end > urls[k - 1][1] else "secret"  # noqa: PLW2901
            at = bisect_right(starts, end - 1)
            if (at == 0 or reach[at - 1] <= start) and (kind != "weak_secret" or _mixed(text[start:end])):
                out.append((start, kind, end, role))
    return out


_PARTS = "id long, fixed struct<n_assign: long, n_access: long, n_hex: long, base_sha256: string, base: array<struct<start: long, kind: string, end: long>>>, win long, role string, start long, stop long, kind string, asks boolean"


def parts_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """What the texts hold, a row for each document (`win` null) and for each part in each window it matters to.

    A document is known by its id and the hash of its text, so repeated rows are one document here.
    """

    def start():
        def step(columns):
            rows = []
            for id_, digest, x in zip(*columns, strict=True):
                x = x or ""
                strong = strong_spans(x)
                named = ",".join(f"{k}:{s}:{e}" for s, k, e in strong)
                count = {k: sum(s[1] == k for s in strong) for k in KINDS}
                fixed = {
                    "n_assign": count["assign"], "n_access": count["access"], "n_hex": count["hex"],
                    "base_sha256": hashlib.sha256(named.encode()).hexdigest(), "base": [{"start": s, "kind": k, "end": e} for s, k, e in strong],
                }
                rows.append((id_, digest, fixed, None, None, None, None, None, None))
                weak = weak_spans(x, strong)
                roles = {_ROLE[s[1]] for s in strong} | {w[3] for w in weak}
                if not weak or not any(r in roles for w in weak for r in _SUPPORT[w[3]]):
                    continue
                breaks = [m.start() for m in _BREAK.finditer(x)]
                for s, k, e, role, asks in [*((s, k, e, _ROLE[k], False) for s, k, e in strong), *((*w, True) for w in weak)]:
                    scope = bisect_right(breaks, s)
                    # A window is a scope and a stretch of REACH code points; the number of both in one long.
                    window = lambda at, scope=scope: scope * (len(x) // REACH + 3) + at
                    for at in range(s // REACH, (e - 1) // REACH + 1):
                        rows.append((id_, digest, None, window(at), role, s, e, k, False))
                    if asks:
                        for at in range(max(0, s - REACH) // REACH, (e + REACH) // REACH + 1):
                            rows.append((id_, digest, None, window(at), role, s, e, k, True))
            return list(zip(*rows, strict=True)) if rows else None

        return step

    kind = docs.schema[key].dataType.simpleString()
    picked = docs.select(F.col(key).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("digest"), F.col(text).alias("text"))
    return map_columns(picked, _PARTS.replace("id long", f"id {kind}, digest long", 1), start)


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: key, counts and hash of the strong spans, `spans` with all, and `n_linked` weak ones.

    Null and empty texts have no spans. Rows with equal key and text give equal rows, as many as
    there are. Other columns of `docs` are not looked at. Two shuffles, of spans and counts only.
    """
    parts = parts_of(docs, key, text)
    # A window is REACH code points wide and spans of one kind don't overlap, so these lists are short.
    met = parts.groupBy("id", "digest", "win").agg(
        F.first("fixed", ignorenulls=True).alias("fixed"), F.sum(F.col("win").isNull().cast("long")).alias("copies"),
        F.collect_set(F.when(F.col("asks"), F.struct("start", "kind", F.col("stop").alias("end"), "role"))).alias("asking"),
        F.collect_set(F.when(~F.col("asks"), F.struct("role", "start", F.col("stop").alias("end")))).alias("parts"),
    )

    def supported(x):
        near = lambda p: (p["start"] < x["end"] + REACH) & (p["end"] > x["start"] - REACH)
        wanted = lambda p: reduce(or_, ((x["role"] == role) & p["role"].isin(*by) for role, by in _SUPPORT.items()))
        # An account name may look random itself. A secret that overlaps a place stands in its userinfo.
        other = lambda p: (x["role"] == "endpoint") | (p["role"] == "endpoint") | (p["start"] >= x["end"]) | (p["end"] <= x["start"])
        return F.exists("parts", lambda p: wanted(p) & near(p) & other(p))

    linked = F.transform(F.filter("asking", supported), lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    whole = met.select("id", "digest", "fixed", "copies", linked.alias("linked")).groupBy("id", "digest").agg(
        F.first("fixed", ignorenulls=True).alias("fixed"), F.max("copies").alias("copies"),
        F.array_distinct(F.flatten(F.collect_list("linked"))).alias("linked"),
    )
    rank = lambda s: F.struct(s["start"], F.array_position(F.array(*map(F.lit, [*KINDS, *(w[0] for w in _WEAK)])), s["kind"]), s["end"])
    keyed = F.array_sort(F.transform(F.concat("fixed.base", "linked"), lambda s: F.struct(rank(s).alias("rank"), s.alias("span"))))
    spans = F.transform(keyed, lambda s: s["span"])
    out = whole.select(
        F.col("id").alias(key), "fixed.n_assign", "fixed.n_access", "fixed.n_hex", "fixed.base_sha256",
        F.size("linked").cast("long").alias("n_linked"), spans.alias("found"), "digest", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    )
    text_of = F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return out.select(key, "n_assign", "n_access", "n_hex", "base_sha256", F.array_join(text_of, ",").alias("spans"), "n_linked", "found", "digest")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked")


#: What a text with any part at all holds; other texts need no look at their spans.
_ANY = r"(?i)passw(or)?d|secret|token|api_?key|akia[a-z0-9]|[0-9a-f]{24}|[a-z0-9+/_-]{20}"
MASK = "[secret]"


def mask(text, spans):
    """`text` without its spans, each run of touching spans replaced by MASK; `spans` are sorted by start."""
    cut = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(MASK)).alias("out"), s["end"].alias("at"))).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))),
        lambda acc: F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"))),
    )
    return F.when(F.size(spans) > 0, cut).otherwise(text)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks what is found; all documents stay. Only texts that may hold anything meet their spans."""
    some = docs.where(F.coalesce(F.col("text").rlike(_ANY), F.lit(False)))
    rest = docs.where(~F.coalesce(F.col("text").rlike(_ANY), F.lit(False)))
    found = find_secrets(some).where(F.size("found") > 0).select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "found").dropDuplicates(["__id", "__digest"])
    met = some.withColumn("__digest", F.xxhash64(F.coalesce("text", F.lit("")))).alias("d").join(
        found.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.__id")) & (F.col("d.__digest") == F.col("f.__digest")), "left"
    )
    spans = F.coalesce(F.col("f.found"), F.array().cast("array<struct<start: bigint, kind: string, end: bigint>>"))
    masked = [mask(F.col("d.text"), spans).alias("text") if c == "text" else F.col(f"d.{c}") for c in docs.columns]
    return rest.select(*docs.columns).unionByName(met.select(*masked))
