"""URL filter: rules first, else logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratalake.sources import stage

ALLOW, BLOCK = "allow", "block"
GRAMS = (3, 4)
BUCKETS = 1 << 14
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = "://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest of ``rules`` (verdict, host, path) that fits, as a struct; null if none does.

    Among rules of the same length a block precedes, then the order of the text.
    The rules are part of the expression: keep them to a few thousand.
    """
    if not rules:
        return F.lit(None).cast("struct<length: int, verdict: string, rule: string>")
    fitting = F.array_compact(
        F.array(
            *(
                F.when(
                    ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}")))
                    & F.startswith(path, F.lit(rule_path)),
                    F.struct(
                        F.lit(len(rule_host) + len(rule_path)).alias("length"),
                        F.lit(verdict).alias("verdict"),
                        F.lit(rule_host + rule_path).alias("rule"),
                    ),
                )
                for verdict, rule_host, rule_path in rules
            )
        )
    )
    return F.array_max(fitting)


def _grams(kind: str, text: Column) -> Column:
    """Buckets of the character n-grams of ``text``, its ends marked."""
    letters = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")

    def hashed(chars: Column) -> Column:
        return F.concat(
            *(
                F.when(
                    F.size(chars) >= n,
                    F.transform(
                        F.sequence(F.lit(1), F.greatest(F.size(chars) - n + 1, F.lit(1))),
                        lambda i, n=n: F.pmod(
                            F.xxhash64(F.lit(kind), F.concat_ws("", F.slice(chars, i, n))), F.lit(BUCKETS)
                        ).cast("int"),
                    ),
                ).otherwise(F.array().cast("array<int>"))
                for n in GRAMS
            )
        )

    # Through a lambda, so that the letters are split once and not for each gram.
    return F.flatten(F.transform(F.array(letters), hashed))


def url_features(host: Column, path: Column) -> Column:
    """Distinct buckets, and one above all that stands for the constant."""
    return F.concat(F.array_distinct(F.concat(_grams("host", host), _grams("path", path))), F.array(F.lit(BUCKETS)))


def _block_odds(features: Column, weights: Sequence[float]) -> Column:
    table = F.from_json(F.lit("[" + ",".join(repr(w) for w in weights) + "]"), "array<double>")
    total = F.aggregate(features, F.lit(0.0), lambda s, f: s + F.element_at(table, f + 1))
    return total / F.sqrt(F.size(features))


def fit_url_model(
    labelled: DataFrame, max_labelled: int = 5000, steps: int = 40, rate: float = 0.5, decay: float = 0.02
) -> list[float]:
    """Weights of a logistic regression for ``label`` = block over ``url``, by adaptive gradient steps.

    Learns from at most ``max_labelled`` rows (those with the smallest hash); rows
    without a label are left out; the two labels weigh the same. Each step is one aggregation over the labelled
    table; the driver holds the weights, one per bucket. With no row left, or one
    label only, all weights but the constant stay small and the verdict is that label.
    """
    url = F.col("url")
    rows = stage(
        labelled.filter(F.col("label").isin(ALLOW, BLOCK))
        .orderBy(F.xxhash64(url), url, "label")
        .limit(max_labelled)
        .select(
            (F.col("label") == BLOCK).cast("int").alias("y"),
            url_features(host_of(url), path_of(url)).alias("features"),
        ),
        "url-labels",
    )
    allowed, blocked = rows.agg(F.sum(1 - F.col("y")), F.sum("y")).first()
    # Both labels weigh the same, however many rows either has.
    weight = F.when(F.col("y") == 1, allowed / blocked).otherwise(1.0) if allowed and blocked else F.lit(1.0)
    weights, seen = [0.0] * (BUCKETS + 1), [1e-8] * (BUCKETS + 1)
    for _ in range(steps):
        chance = 1 / (1 + F.exp(-_block_odds(F.col("features"), weights)))
        slopes = (
            rows.select("features", (weight * (chance - F.col("y")) / F.sqrt(F.size("features"))).alias("miss"))
            .select(F.explode("features").alias("bucket"), "miss")
            .groupBy("bucket")
            .agg(F.sum("miss").alias("slope"))
        )
        for bucket, slope in slopes.collect():
            slope += decay * weights[bucket]
            seen[bucket] += slope * slope
            weights[bucket] = round(weights[bucket] - rate * slope / math.sqrt(seen[bucket]), 6)
    return weights


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], weights: Sequence[float], threshold: float = 0.5
) -> DataFrame:
    """Host, path, rule, score and verdict of every page's ``url``.

    The longest rule (verdict, host, path) whose host is the url's or a parent of
    it, and whose path begins the url's, decides; else the model does: block
    from ``threshold`` on. A null url or one without ``://`` has an empty host
    and path, which the model judges too. Repeated rows are judged alike; an
    empty table gives no rows; other columns are not looked at.

    Columns: page_id, host, path, rule, score, verdict.
    """
    url = F.col("url")
    parsed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    judged = parsed.select(
        "*",
        matching_rule(F.col("host"), F.col("path"), rules).alias("found"),
        url_features(F.col("host"), F.col("path")).alias("features"),
    ).select("*", (1 / (1 + F.exp(-_block_odds(F.col("features"), weights)))).alias("score"))
    by_model = F.when(F.col("score") >= threshold, BLOCK).otherwise(ALLOW)
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        "score",
        F.coalesce(F.col("found.verdict"), by_model).alias("verdict"),
    )


# Words of made-up sites, by the kinds that corpus builders block, and of those they keep.
BLOCKED_WORDS = {
    "gambling": "casino poker betting bets slots roulette jackpot bingo lottery wager blackjack sportsbook",
    "adult": "adult porn xxx nude erotic escort camgirl fetish hookup sexy milf webcam",
    "pharmacy": "pills viagra cialis steroid pharma tramadol xanax slimming dosage kratom",
    "advertising": "ads adserver banner tracker tracking popup clicks affiliate retarget adnetwork pixel",
    "link farms": "spam linkfarm backlink seolinks doorway spammy linkswap autoblog",
    "fraud": "phishing giveaway prizewin payday quickloan doubler ponzi airdrop winner richquick",
    "malware": "malware keygen crack warez trojan torrent nulled botnet stealer ransom",
    "counterfeits": "replica fakewatch knockoff counterfeit diploma-mill",
}
ALLOWED_WORDS = {
    "learning": "library university school college museum archive lecture science physics botany algebra grammar",
    "public life": "council parliament hospital charity embassy ministry court firestation township census",
    "press": "herald gazette tribune journal magazine newsroom editorial weekly chronicle reporter",
    "home": "recipes garden kitchen knitting furniture family baking carpentry pottery cottage",
    "outdoors": "mountain river forest cycling sailing hiking valley island meadow lake",
    "culture": "orchestra theatre cinema poetry novels gallery history opera folklore painting",
    "work": "software engineering docs forum logistics accounting bakery bookshop printing surveyor",
    "names": "anderson whitfield morgan oakley bennett sinclair rossi keller novak laurent",
}
# Around the words of both kinds, so that none of this tells them apart.
_HOSTS = (
    "{0}.example", "www.{0}-{1}.com", "{0}{1}.net", "www.best-{0}.org", "my{0}.invalid",
    "the-{0}-site.org", "www.{0}4you.com", "online-{0}.net", "free-{0}-{1}.test", "m.{0}.test",
)
_PATHS = ("", "/", "/index.html", "/a/{0}.html", "/pages/{0}")
# Names of two syllables, of which nothing is known: they are kept, so that only what speaks for a block blocks.
_ONSETS, _VOWELS, _CODAS = "b br c ch d f fl g gr h j k l m n p pr r s sh st t th tr v w".split(), "aeiou", "n r l s t nd ng ck m th".split()
UNKNOWN_NAMES = 200


def _syllables(k: int) -> str:
    """The ``k``-th name: steps prime to the numbers of parts go through all of them evenly."""
    first = _ONSETS[k % 26] + _VOWELS[k % 5] + _CODAS[k * 3 % 10]
    return first + _ONSETS[k * 7 // 5 % 26] + _VOWELS[k * 3 // 7 % 5] + _CODAS[k * 7 // 3 % 10]


def sample_url_labels(spark: SparkSession) -> DataFrame:
    """The made-up labelled table: url, label. Each word is put into every shape of host, next to others of its kind."""
    kinds = [(BLOCK, row.split()) for row in BLOCKED_WORDS.values()] + [(ALLOW, row.split()) for row in ALLOWED_WORDS.values()]
    kinds.append((ALLOW, [_syllables(k) for k in range(UNKNOWN_NAMES)]))
    words = [
        F.struct(F.lit(label).alias("label"), F.lit(word).alias("word"), F.lit(other).alias("other"), F.lit(k).alias("k"))
        for label, row in kinds
        for k, (word, other) in enumerate(zip(row, row[1:] + row[:1], strict=True))
    ]
    shapes = F.array(*(F.lit(h) for h in _HOSTS))
    paths = F.array(*(F.lit(p) for p in _PATHS))
    rows = spark.range(1).select(F.explode(F.array(*words)).alias("w")).select("w.*", F.posexplode(shapes).alias("n", "host"))
    number = F.col("k") * 10 + F.col("n")
    host = F.replace(F.replace("host", F.lit("{0}"), F.col("word")), F.lit("{1}"), F.col("other"))
    path = F.replace(F.element_at(paths, number % len(_PATHS) + 1), F.lit("{0}"), number.cast("string"))
    return rows.select(F.concat(F.lit("https://"), host, path).alias("url"), "label")
