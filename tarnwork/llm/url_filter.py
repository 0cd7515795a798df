"""URL filter: host and path rules, else logistic regression on hashed character n-grams.

Everything on tables is built from DataFrame functions. The model is fitted once on a small labelled
table: one given as a DataFrame (at most MAX_LABELLED rows reach the driver, those with the smallest hash), or the built-in
one, which is made by a rule from the word lists below, with the same shapes of hosts and paths for both labels. Its weights
are integers in millionths, so that a score is an exact sum.

Defined cases: a null url, or one without "://", has an empty host and path and is judged by the model
on those; repeated rows each get their own result; an empty labelled table allows all.
"""

from __future__ import annotations

import functools
import hashlib
import random

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed values: (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
GRAM, BUCKETS = 3, 4096  # a bucket is the first three hex digits of the n-gram's MD5
MAX_LABELLED = 20_000

# Words of hosts and paths to block (gambling, pills, adult, piracy, loans, fakes, link spam), and of others.
BLOCK_WORDS = """casino poker slots roulette jackpot lotto bets betting bookie odds win winner prize bonus spins
pills meds pharma viagra cialis tablets slimming adult porn xxx sex cams nude erotic escort singles
warez torrent crack keygen serial nulled loans payday cash forex credit replica rolex outlet discount cheap free deals
spam farm backlinks seo traffic followers hits""".split()
ALLOW_WORDS = """news press daily journal magazine review weekly blog forum wiki docs library archive books school college
university campus teacher physics chemistry history science museum gallery music theatre cinema garden cooking bread
kitchen travel mountain river lake island harbour bridge weather climate forest animal health clinic doctor family
parents children city council region law court statute bank insurance engine software python code project data map
sport football chess cycling running photo design craft wood paper glass stone green blue north south east west
free cheap win cash farm""".split()
SYLLABLES = "ba be bi bo da de di do fa fi ga go ha he in ing ka ke la le li ly ma me mi na ne ni on or ou pa pe ra re ri sa se si sh ta te th ther ti tion ton un ver wa we wh".split()
TABLE_ROWS = 1500  # of each label


def labelled_urls(rows: int = TABLE_ROWS, seed: int = 5) -> list[tuple[str, int]]:
    """The built-in table: (url, 1 for block). Both labels share prefixes, domains, paths and joints; block hosts join two block words, others two other words or syllables."""
    r = random.Random(seed)
    plain = lambda: "".join(r.choice(SYLLABLES) for _ in range(r.randint(2, 4)))

    def host(words):
        one, two = r.sample(words, 2)
        return f"{one}{r.choice(['-', '-', ''])}{two}"

    def url(name):
        tail = r.choice([f"{r.randint(1, 9999)}", f"{r.randint(1, 9999)}.html", f"{plain()}/{r.randint(1, 99)}", f"{plain()}-{plain()}", ""])
        where = r.choice(["en", "de", "fr", "es", "posts", "page", plain()])
        return f"{r.choice(['http', 'https'])}://{r.choice(['', '', 'www.', 'blog.', 'm.'])}{name}.example{r.choice(['', '.com', '.net', '.org'])}/{where}/{tail}"

    block = [(url(host(BLOCK_WORDS)), 1) for _ in range(rows)]
    named = [(url(host(ALLOW_WORDS)), 0) for _ in range(rows // 2)]
    return block + named + [(url(r.choice([plain(), plain(), f"{plain()}-{plain()}", f"{plain()}-{r.choice(ALLOW_WORDS)}"])), 0) for _ in range(rows - rows // 2)]


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; null if none fits. Ties go to the first by text."""
    text = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1]), reverse=False):
        hit = fits(host, path, h, p)
        text, verdict = F.when(hit, F.lit(h + p)).otherwise(text), F.when(hit, F.lit(v)).otherwise(verdict)
    return text, verdict


# the model


def _parts(url: str) -> str:
    _, sep, rest = url.partition("://")
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)]) if sep else 0
    host = rest[:cut] if sep else ""
    tail = rest[cut:] if sep else ""
    end = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return f"^{host.translate(str.maketrans(UPPER, LOWER))}|{tail[:end]}$"


def _buckets(s: str) -> list[int]:
    return [int(hashlib.md5(s[i : i + GRAM].encode()).hexdigest()[:3], 16) for i in range(len(s) - GRAM + 1)]


@functools.lru_cache(maxsize=1)
def built_in_model() -> tuple[int, tuple[int, ...]]:
    """The model of the built-in table, fitted once in a process."""
    bias, weights = fit_url_model(labelled_urls())
    return bias, tuple(weights)


def fit_url_model(rows, *, epochs: int = 1500, rate: float = 30.0, decay: float = 1e-5) -> tuple[int, list[int]]:
    """Bias and BUCKETS weights in millionths, by gradient descent on the logistic loss of the mean weight of a url's n-grams.

    rows: (url, 1 for block), or a DataFrame with url and label (at most MAX_LABELLED rows are used, those with the smallest hash of the url).
    """
    if isinstance(rows, DataFrame):
        chosen = rows.where("url is not null and label is not null").orderBy(F.xxhash64(F.lit("sample"), "url"), "url", "label").limit(MAX_LABELLED)
        rows = sorted((r["url"], r["label"]) for r in chosen.collect())
    if not rows:
        return -1_000_000, [0] * BUCKETS
    each = [_buckets(_parts(u)) for u, _ in rows]
    y, size = np.array([float(label) for _, label in rows]), np.array([len(g) for g in each])
    grams, first = np.concatenate(each).astype(np.int64), np.concatenate([[0], np.cumsum(size)[:-1]])
    w, b = np.zeros(BUCKETS), 0.0
    for _ in range(epochs):
        z = b + np.add.reduceat(w[grams], first) / size
        e = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        b -= 0.2 * e.mean()
        w = (w - rate * np.bincount(grams, np.repeat(e / size, size), BUCKETS) / len(y) * 10) * (1 - decay)
    return round(b * 1e6), [round(x * 1e6) for x in w.tolist()]


def url_score(host: Column, path: Column, model: tuple[int, list[int]]) -> Column:
    """Positive: block. n-grams times the bias plus the weights of all n-grams, in millionths."""
    bias, weights = model
    table = F.split(F.lit(",".join(str(int(x)) for x in weights)), ",").cast("array<bigint>")  # folded to a constant
    chars = F.filter(F.split(F.concat(F.lit("^"), host, F.lit("|"), path, F.lit("$")), ""), lambda c: c != "")
    grams = let(chars, lambda cs: F.transform(F.sequence(F.lit(0), F.size(cs) - GRAM), lambda i: F.concat(*[F.get(cs, i + k) for k in range(GRAM)])))
    bucket = lambda g: F.conv(F.substring(F.md5(F.encode(g, "utf-8")), 1, 3), 16, 10).cast("int")
    return F.aggregate(grams, F.lit(0).cast("long"), lambda acc, g: acc + F.get(table, bucket(g)) + F.lit(bias))


def judge_urls(pages: DataFrame, model: tuple[int, list[int]] | None = None, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, model_score of every row. One narrow pass."""
    model = model or built_in_model()
    u = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(u).alias("host"), path_of(u).alias("path"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", text.alias("rule"), verdict.alias("by_rule"), url_score(F.col("host"), F.col("path"), model).alias("model_score"))
    return rows.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.when(F.col("model_score") > 0, "block").otherwise("allow")).alias("verdict"), "model_score")


def oracle(model: tuple[int, list[int]] | None = None) -> str:
    """DuckDB SQL for judge_urls on the view pages."""
    bias, weights = model or built_in_model()
    whens = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{{{k}}}'" for k, (h, p, v) in enumerate(sorted(RULES, key=lambda r: -len(r[0] + r[1]))))
    order = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    case = lambda pick: "CASE " + whens.format(*[pick(r) for r in order]) + " END"
    return f"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (
  SELECT page_id, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM parts),
scored AS (
  SELECT page_id, host, path, {case(lambda r: r[0] + r[1])} AS rule, {case(lambda r: r[2])} AS by_rule,
    CAST(list_sum(list_transform(range(1, CAST(length('^' || host || '|' || path || '$') - {GRAM - 1} + 1 AS BIGINT)),
      lambda i: {bias} + list_extract({list(weights)}, CAST('0x' || substr(md5(substr('^' || host || '|' || path || '$', i, {GRAM})), 1, 3) AS INTEGER) + 1))) AS BIGINT) AS model_score
  FROM named)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN model_score > 0 THEN 'block' ELSE 'allow' END) AS verdict, model_score FROM scored"""
