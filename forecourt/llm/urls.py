"""URL filters: explicit rules first, then trust and distrust spread over the links between hosts.

A url's host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; its path is the
rest up to ``?``, ``#`` or the end. A rule fits its host and all subdomains, if the path starts with the rule's; the
longest fitting rule wins (of equally long ones, that of the longer host).

Pages without a rule get their host's verdict. Seeds are the pages that rules decide: a host's trust mass is its
allowed pages, its distrust mass its blocked ones, over all decided pages. Trust is a personalised PageRank along
links from the trusted seeds; distrust is one against the links from the blocked seeds. Mass at a host without
further links is not passed on. A host whose distrust exceeds ``ratio`` times its trust is blocked; a host that
neither reaches is allowed. Rounds go on until every host's mass has settled, relative to itself, however far it lies
from a seed; masses are compared relatively too, so verdicts don't depend on how many other pages there are. Links are aggregated to one weighted edge per pair of hosts; only sums per host are shuffled in a round, and only
one number per round reaches the driver.

Defined cases: a null url or one without ``://`` has an empty host and path and no rule, and is allowed; a null html
has no links; repeated pages count as often as they occur; an empty table gives no rows; further columns are left
alone. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import UPPER, ascii_lower, query, rewritten, table
from forecourt.session import materialize

# The rules of the contract as (host, path, verdict).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
DAMPING = 0.85
#: An error, and no bound of the work: rounds settle after the graph's depth and some 150 more.
MOST_ROUNDS = 100_000
RATIO = 1.0
#: Masses whose ratio is this close to 1 are equal, whatever their size.
EQUAL = 1e-9
#: Rounds end when no host's mass changes by more than this share of it: what is still to come is then at most
#: damping / (1 - damping) times that, less than EQUAL.
SETTLED = 1e-10

HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*([^"'\s>]+)"""


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(_after(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): the rules whose host is ``host`` or a parent domain of it, longest first."""
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parent = hosts.select("host", F.explode(suffix).alias("rule_host"))
    rule = F.struct((-F.length(F.concat("rule_host", "rule_path"))).alias("n"), (-F.length("rule_host")).alias("h"), "rule_host", "rule_path", "rule_verdict")
    return parent.join(rules, "rule_host").groupBy("host").agg(F.array_sort(F.collect_set(rule)).alias("rules"))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, links) between different hosts, from ``pages`` of (host, html)."""
    target = F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(HREF), F.lit(1)))
    link = pages.select(F.col("host").alias("src"), target.alias("to"))
    absolute = F.when(F.col("to").startswith("//"), F.concat(F.lit("http:"), "to")).otherwise(F.col("to"))
    link = link.select("src", host_of(absolute).alias("dst")).where("src <> '' and dst <> '' and src <> dst")
    return link.groupBy("src", "dst").agg(F.count("*").alias("links"))


def spread_masses(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING) -> DataFrame:
    """(kind, host, mass): trust along ``edges`` and distrust against them, from ``seeds`` of (kind, host, mass), until it settles."""
    edges = materialize(edges, "host-edges")
    out = edges.groupBy("src").agg(F.sum("links").alias("n"))
    into = edges.groupBy("dst").agg(F.sum("links").alias("n"))
    arc = lambda kind, a, b: [F.lit(kind).alias("kind"), F.col(a).alias("host"), F.col(b).alias("to"), (F.col("links") / F.col("n")).alias("share")]
    trust = edges.join(out, "src").select(*arc("trust", "src", "dst"))
    distrust = edges.join(into, "dst").select(*arc("distrust", "dst", "src"))
    arcs = materialize(trust.unionByName(distrust), "host-arcs")
    seeds = materialize(seeds, "host-seeds")
    masses, path = seeds, None
    for _ in range(MOST_ROUNDS):
        moved = arcs.join(masses, ["kind", "host"]).select("kind", F.col("to").alias("host"), (F.col("share") * F.col("mass") * damping).alias("mass"))
        stay = seeds.withColumn("mass", F.col("mass") * (1 - damping))
        new = moved.unionByName(stay).withColumn("was", F.lit(0.0))
        old = masses.select("kind", "host", F.lit(0.0).alias("mass"), F.col("mass").alias("was"))
        both = new.unionByName(old).groupBy("kind", "host").agg(F.sum("mass").alias("mass"), F.sum("was").alias("was"))
        both, path = rewritten(both, "host-masses", path)
        masses = both.select("kind", "host", "mass")
        if not both.where(F.abs(F.col("mass") - F.col("was")) > F.col("mass") * SETTLED).agg(F.count("*")).first()[0]:
            return masses
    raise RuntimeError(f"masses have not settled after {MOST_ROUNDS} rounds")


def judge(pages: DataFrame, rules: DataFrame, damping: float = DAMPING, ratio: float = RATIO) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict. ``rules`` has rule_host, rule_path and rule_verdict."""
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    hosts = split.where("host <> ''").groupBy("host").agg(F.count("*").alias("pages"))
    known = materialize(rules_of_hosts(hosts.select("host"), rules), "host-rules")
    best = F.get(F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"])), F.lit(0))
    ruled = split.join(known, "host", "left").withColumn("best", best)
    decided = ruled.groupBy("host", "best.rule_verdict").agg(F.count("*").alias("n")).where("rule_verdict is not null")
    decided = materialize(decided, "host-decided")
    total = decided.agg(F.sum("n")).first()[0] or 1
    kind = F.when(F.col("rule_verdict") == "allow", "trust").otherwise("distrust")
    seeds = decided.select(kind.alias("kind"), "host", (F.col("n") / F.lit(total)).alias("mass"))
    masses = spread_masses(seeds, host_edges(pages.select(host_of(F.col("url")).alias("host"), "html")), damping)
    of = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("mass"))), F.lit(0.0))
    blocked = masses.groupBy("host").agg(of("trust").alias("t"), of("distrust").alias("d")).where(F.col("d") > F.col("t") * ratio * (1 + EQUAL))
    spread = blocked.select("host", F.lit("block").alias("host_verdict"))
    return ruled.join(spread, "host", "left").select(
        "page_id",
        "host",
        "path",
        F.concat("best.rule_host", "best.rule_path").alias("rule"),
        F.coalesce("best.rule_verdict", "host_verdict", F.lit("allow")).alias("verdict"),
    )


def _sql() -> str:
    lower = lambda c: f"translate({c}, '{UPPER}', '{UPPER.lower()}')"
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    after = "case when strpos({0}, '://') > 0 then substr({0}, strpos({0}, '://') + 3) else '' end"
    parts = [
        f"""p as (select page_id, html, {lower("regexp_extract(a, '^[^/?#]*')")} as host, regexp_extract(a, '^[^/?#]*([^?#]*)', 1) as path
  from (select page_id, html, coalesce({after.format("url")}, '') as a from pages))""",
        f"r(rh, rp, rv) as (values {values})",
        """b as (select page_id, host, path, (select {'u': rh || rp, 'v': rv} from r where (host = rh or host like '%.' || rh) and starts_with(path, rp)
  order by length(rh || rp) desc, length(rh) desc limit 1) as best from p)""",
        r"""l as (select host as src, case when x like '//%' then 'http:' || x else x end as x from (select host,
  unnest(regexp_extract_all(coalesce(html, ''), '(?i)<a\s[^>]*?href\s*=\s*["'']?\s*([^"''\s>]+)', 1)) as x from p))""",
        f"""e as (select src, dst, count(*) as n from (select src, {lower(f"regexp_extract({after.format('x')}, '^[^/?#]*')")} as dst from l)
  where src <> '' and dst <> '' and src <> dst group by all)""",
        "arcs as (select 'allow' as k, src as h, dst as o, n / sum(n) over (partition by src) as s from e union all select 'block', dst, src, n / sum(n) over (partition by dst) from e)",
        "seeds as (select best.v as k, host as h, count(*) / sum(count(*)) over () as m from b where best is not null group by all)",
        # The masses as a power series, to a term that no sum of doubles can see.
        f"""t as (select 0 as i, k, h, m * {1 - DAMPING} as m from seeds union all
  select i + 1, arcs.k, o, sum(s * m * {DAMPING}) from t join arcs using (k, h) where i < 400 group by i, arcs.k, o)""",
    ]
    mass = lambda k: f"coalesce(sum(m) filter (k = '{k}'), 0)"
    parts.append(f"bad as (select h from t group by h having {mass('block')} > {mass('allow')} * {RATIO * (1 + EQUAL)!r})")
    last = "select page_id, host, path, best.u as rule, coalesce(best.v, case when host in (select h from bad) then 'block' else 'allow' end) as verdict from b"
    return "with recursive " + ",\n".join(parts) + "\n" + last


@query("op5_url_filter", _sql())
def op5(spark, folder):
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    rules = spark.sql(f"select * from values {values} as r(rule_host, rule_path, rule_verdict)")
    return judge(table(spark, folder, "pages"), rules)
