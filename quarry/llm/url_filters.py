"""URL filters (operator 3); DataFrame functions only.

Rules on host and path decide first. For the rest, a logistic regression on hashed character n-grams of host and path
does, trained from a small labelled table of URLs. Features are hashed by the same Spark expression for training and
judging; training reads at most ``TABLE_ROWS`` rows to the driver and gives ``BUCKETS`` weights, a literal of the plan.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import evaluated_once

BUCKETS, SIZES, TABLE_ROWS = 32_768, (3, 4, 5), 10_000
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Words of the labelled table by kinds of sites. They were written down from what such sites are about, without the tables that are judged.
BLOCKED = {
    "gambling": "poker roulette jackpot lottery blackjack betting wager bingo slots dice baccarat sportsbook",
    "medicine": "viagra cialis steroid opioid painkiller slimming tramadol botox pharmacy",
    "sex": "porn sex nude escort erotic webcam fetish hentai milf",
    "malware": "trojan malware keylogger phishing exploit ransomware botnet rootkit",
    "piracy": "warez torrent crack keygen serial cheats",
    "fraud": "payday loan doubler giveaway prize pyramid scam inheritance",
    "counterfeit": "replica knockoff fake passport diploma",
    "advertising": "banner popup pixel beacon affiliate adserver telemetry retarget",
    "mass mail": "mailer backlinks clickbait bulkmail harvester linkexchange",
}
ALLOWED = {
    "nature": "mountain river garden forest valley coast ocean lake stone tree flower weather island desert",
    "town": "museum market school station harbour village bridge street library hospital church theatre parish",
    "learning": "physics history science grammar algebra lecture thesis dictionary archive essay lesson",
    "home": "kitchen recipe bread supper window cottage knitting furniture painting bicycle family children",
    "state": "council parliament ministry census statute court treaty election passports embassy",
    "software": "kernel compiler editor manual forum patch source package browser database",
    "arts": "poem novel orchestra sculpture gallery opera sonata cinema festival ballet",
    "work": "carpenter bakery nursery dairy mill shipyard union factory office workshop",
    "german": "garten wetter schule kirche stadt wasser zeitung verein bahnhof rathaus wandern sprache",
    "french": "jardin ecole eglise mairie musee cuisine voyage marche boulangerie lumiere riviere",
    "spanish": "biblioteca noticias ciencia escuela iglesia mercado salud montana playa periodico camino",
}


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; null or without ://: empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def characters(text: Column) -> Column:
    """The characters of a text with a mark at both ends; all digits count as 0."""
    return F.split(F.translate(F.concat(F.lit("^"), text, F.lit("$")), "123456789", "000000000"), "")


def grams(chars: Column) -> Column:
    """Bucket of every n-gram of an array of characters, which must be a column of its own: the lambdas read it for each."""
    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(chars) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.array_join(F.slice(chars, i, F.lit(n)), "")), F.lit(BUCKETS)).cast("int"))

    return F.concat(*map(of, SIZES))


def with_grams(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` with __grams, in time proportional to the text's length."""
    return rows.withColumn("__chars", evaluated_once(characters(text))).withColumn("__grams", evaluated_once(grams(F.col("__chars")))).drop("__chars")


def names(kinds: dict[str, str]) -> list[list[str]]:
    """The words of each site's name: every word alone, and with the next and the next but one of its kind."""
    out = []
    for words in map(str.split, kinds.values()):
        for i, w in enumerate(words):
            out += [[w], [w, words[(i + 1) % len(words)]], [words[(i + 2) % len(words)], w]]
    return out


def seed_table(spark: SparkSession) -> DataFrame:
    """The built-in labelled table: url, blocked, words (of the site's name)."""
    # hosts, paths and numbers of any length come with both labels alike, so that only the names tell
    forms = ("http://{}.com/", "https://www.{}.net/index.html", "https://{}.org/a/{}", "http://shop.{}.info/items/{}.html", "https://{}.co/p?id={}")
    rows = [(f.format("-".join(ws), i * i * 7919 % 10 ** (1 + i % 4)), y, ws) for y, kinds in ((1, BLOCKED), (0, ALLOWED)) for i, ws in enumerate(names(kinds)) for f in forms]
    return spark.createDataFrame(rows, "url string, blocked int, words array<string>")


def train(labelled: DataFrame, rounds: int = 250, rate: float = 20.0, decay: float = 1e-5) -> tuple[list[float], float]:
    """Weights and bias by gradient descent on the mean log loss of the two labels. Null urls count as empty, null labels teach nothing."""
    rows = labelled.where("blocked is not null").select(F.concat(host(F.col("url")), path(F.col("url"))).alias("u"), "blocked")
    rows = with_grams(rows, F.col("u")).select(F.col("__grams").alias("g"), "blocked").limit(TABLE_ROWS + 1).collect()
    if len(rows) > TABLE_ROWS:
        raise ValueError(f"the labelled table must have at most {TABLE_ROWS} rows")
    if not rows:
        return [0.0] * BUCKETS, 0.0
    size = np.array([len(r.g) for r in rows])
    row, k, y = np.repeat(np.arange(len(rows)), size), np.concatenate([r.g for r in rows]), np.array([r.blocked for r in rows])
    v, used = 1 / np.sqrt(size)[row], np.unique(k)
    share = 1 / (len(np.unique(y)) * np.bincount(y, minlength=2)[y])  # both labels weigh the same
    w, b = np.zeros(BUCKETS), 0.0
    for _ in range(rounds):
        z = b + np.bincount(row, w[k] * v, len(rows))
        r = (y - 1 / (1 + np.exp(-z))) * share
        w[used] += rate * (np.bincount(k, r[row] * v, BUCKETS) - decay * w)[used]
        b += rate * r.sum()
    return [round(x, 4) or 0 for x in w.tolist()], round(float(b), 4)


def probability(each: Column, model: tuple[list[float], float]) -> Column:
    """Of being blocked, from the n-grams of host and path."""
    weights = F.split(F.lit(",".join(map(str, model[0]))), ",").cast("array<double>")
    z = F.aggregate(each, F.lit(0.0), lambda s, k: s + F.element_at(weights, k + 1)) / F.sqrt(F.size(each)) + F.lit(model[1])
    return 1 / (1 + F.exp(-z))


def rule_of(at_host: Column, at_path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null if none does. Of equally long ones the first listed wins."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: len(r[0])) if len({len(r[0]) for r in rules}) == len(rules) else sorted(reversed(rules), key=lambda r: len(r[0])):
        h, slash, p = rule.partition("/")
        fits = ((at_host == h) | at_host.endswith("." + h)) & at_path.startswith(slash + p)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, labelled: DataFrame, rules=RULES, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block), p_block (null where a rule decided) of every row of ``pages``.

    A null url or one without :// has an empty host and path; no rule fits it, and as nothing speaks against it the
    method allows it. Rows are independent; columns besides page_id and url are not looked at. Empty in, empty out.
    """
    model = train(labelled)
    parts = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    name, says = rule_of(F.col("host"), F.col("path"), rules)
    found = parts.withColumn("rule", name).withColumn("says", says)
    text = F.concat("host", "path")
    asked = F.col("rule").isNull() & (F.length(text) > 0)
    found = with_grams(found, F.when(asked, text))
    found = found.withColumn("p_block", evaluated_once(F.when(asked, probability(F.col("__grams"), model))))
    verdict = F.coalesce("says", F.when(F.col("p_block") >= threshold, "block").otherwise("allow"))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "p_block")
