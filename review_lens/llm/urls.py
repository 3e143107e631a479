"""URL filters: rules for hosts and paths, and boosted trees for what no rule fits.

A rule allows or blocks a host with its subdomains and paths that start with its own;
of several the longest decides. The URLs that a rule fits are labelled by it, and
gradient-boosted trees are trained on lexical features of a bounded sample of them:
lengths, depth, shares of digits, entropy, counts of parameters, and statistics of
suffixes. For each suffix of a host, first part of a path and so on there is its number of
URLs, over all of them, and the share of blocked among the labelled. Suffixes are counted
exactly; the frequent ones are broadcast, their number is bounded, the rest is joined.

Defined results: a null URL, or one without `://`, has an empty host and path, so no
rule fits it and the trees judge it. If the labelled URLs are not of both kinds, all
others get the verdict of the labelled ones, or allow. Rows stay as they are, repeated
ones too; other columns than id and URL are not read.
"""

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_lens.llm.common import bounded_sample, settled

ALLOW, BLOCK = "allow", "block"
#: Labelled URLs of each kind that a fit uses, about and at most, picked by a hash.
SAMPLE = 20_000
#: Share of all URLs from which on a suffix is frequent: at most 10,000 of each family are.
FREQUENT = 1e-4
TREES, DEPTH = 12, 4
#: Labelled URLs with the overall share that a suffix's share is mixed with.
PRIOR = 10.0

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"://([^/?#]*)([^?#]*)"


def host_of(url):
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url):
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def ruling(rules: list[tuple[str, str, str]], host, path):
    """(rule, verdict) of the longest rule (verdict, host, path) that fits, null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, own, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(start)
        rule = F.when(fits, own + start).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def count_of(text, chars: str):
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("double")


def entropy(text):
    """Bits a character, by the frequencies in the text itself."""
    size = F.length(text).cast("double")
    share = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / size
    bits = lambda sum_, c: sum_ - share(c) * F.log2(share(c))
    total = F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), bits)
    return F.when(F.length(text) == 0, 0.0).otherwise(total)


def lexical(url, host, path) -> dict:
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    letters = F.regexp_replace(path, r"[^A-Za-z]", "")
    return {
        "url_length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "depth": count_of(path, "/"),
        "labels": count_of(host, "."),
        "digit_share": count_of(url, "0123456789") / size,
        "host_digits": count_of(host, "0123456789"),
        "path_digits": count_of(path, "0123456789"),
        "path_letters": F.length(letters).cast("double"),
        "marks": count_of(url, "-_~%+!@"),
        "entropy": entropy(url),
        "parameters": count_of(query, "="),
        "query_length": F.length(query).cast("double"),
        "fragment": url.contains("#").cast("double"),
        "secure": url.startswith("https:").cast("double"),
        "dots_in_path": count_of(path, "."),
    }


def suffixes(host, path) -> dict:
    """Strings with statistics, one of each family."""
    last = F.substring_index(host, ".", -1)
    start = F.element_at(F.split(F.concat(path, F.lit("/")), "/"), 2)
    return {
        "last_label": last,
        "last_labels": F.substring_index(host, ".", -2),
        "host": host,
        "path_start": start,
        "label_and_start": F.concat(last, F.lit(" "), start),
        "path_end": F.regexp_extract(path, r"(\.[A-Za-z0-9]+|/)?$", 1),
    }


def described(pages: DataFrame, rules, id_column: str, url_column: str) -> DataFrame:
    """id, url, host, path, rule, ruled, the lexical features and the suffixes of each URL."""
    rows = pages.select(F.col(id_column).alias("id"), F.coalesce(F.col(url_column).cast("string"), F.lit("")).alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    host, path = F.col("host"), F.col("path")
    rule, verdict = ruling(rules, host, path)
    parts = F.array(*(F.coalesce(text, F.lit("")) for text in suffixes(host, path).values()))
    return rows.withColumns({"rule": rule, "ruled": verdict, "parts": parts, **lexical(F.col("url"), host, path)})


def suffix_counts(rows: DataFrame) -> DataFrame:
    """(family, suffix, urls, known, blocked) of every suffix of all rows, counted exactly."""
    each = rows.select(F.posexplode("parts").alias("family", "suffix"), "ruled")
    known, blocked = F.col("ruled").isNotNull().cast("bigint"), (F.col("ruled") == BLOCK).cast("bigint")
    return each.groupBy("family", "suffix").agg(
        F.count("*").alias("urls"), F.sum(known).alias("known"), F.coalesce(F.sum(blocked), F.lit(0)).alias("blocked")
    )


def with_counts(rows: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """The rows with a struct c0, c1, ... of the counts of each of their suffixes. Frequent suffixes are broadcast,
    at most 10,000 of a family; what is left is joined on the suffix and gathered by row, so that
    no suffix that many rows share is shuffled."""
    names = list(suffixes(F.lit(""), F.lit("")))
    counted = counts.select("family", "suffix", F.struct("urls", "known", "blocked").alias("c"))
    often = F.col("c.urls") >= total * FREQUENT
    for k in range(len(names)):
        mine = counted.where(often & (F.col("family") == k)).select(F.col("suffix").alias("suffix_"), F.col("c").alias(f"c{k}"))
        rows = rows.join(F.broadcast(mine), F.col("parts")[k] == F.col("suffix_"), "left").drop("suffix_")
    missing = F.filter(
        F.array(*(F.struct(F.lit(k).alias("family"), F.col("parts")[k].alias("suffix"), F.col(f"c{k}").isNull().alias("rare")) for k in range(len(names)))),
        lambda part: part["rare"],
    )
    rare = rows.select("row", F.inline(missing)).join(counted.where(~often), ["family", "suffix"])
    picked = [F.max(F.when(F.col("family") == k, F.col("c"))).alias(f"r{k}") for k in range(len(names))]
    rare = rare.groupBy("row").agg(*picked)
    whole = rows.join(rare, "row", "left")
    found = {f"c{k}": F.coalesce(f"c{k}", f"r{k}") for k in range(len(names))}
    return whole.withColumns(found).drop(*(f"r{k}" for k in range(len(names))))


def statistics(overall: float, own: bool) -> dict:
    """Two features for each suffix of a row with counts. own: leave out the label of the row itself."""
    mine = F.lit(1.0 if own else 0.0)
    its = (F.col("ruled") == BLOCK).cast("double") if own else F.lit(0.0)
    out = {}
    for k, name in enumerate(suffixes(F.lit(""), F.lit(""))):
        share = (F.col(f"c{k}.blocked") - its + PRIOR * overall) / (F.col(f"c{k}.known") - mine + PRIOR)
        out |= {f"{name}_share": share, f"{name}_urls": F.log1p(F.col(f"c{k}.urls"))}
    return out


def judged(
    pages: DataFrame, rules: list[tuple[str, str, str]], id_column="page_id", url_column="url", sample: int = SAMPLE
) -> DataFrame:
    """(id, host, path, rule, verdict, block_score) of every row; block_score: the trees' probability."""
    rows = described(pages, rules, id_column, url_column)
    rows = settled(rows.withColumn("row", F.monotonically_increasing_id()), "urls")
    counts = settled(suffix_counts(rows), "url-suffixes")
    facts = counts.where("family = 0").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("urls", "known", "blocked"))).first()
    if facts["blocked"] in (0, facts["known"]):
        # No two kinds of labels to learn from.
        only = BLOCK if facts["blocked"] else ALLOW
        score = F.lit(float(only == BLOCK))
        verdict = F.coalesce("ruled", F.lit(only)).alias("verdict")
        return rows.select("id", "host", "path", "rule", verdict, score.alias("block_score"))
    overall = facts["blocked"] / facts["known"]
    lexical_names = list(lexical(F.lit(""), F.lit(""), F.lit("")))
    names = [*lexical_names, *statistics(overall, False)]
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    held = settled(with_counts(rows, counts, facts["urls"]), "url-counts")
    labelled = held.where("ruled is not null")
    train = bounded_sample(labelled, F.col("ruled"), [F.col("id"), F.col("url")], sample)
    train = train.withColumns(statistics(overall, True)).withColumn("label", (F.col("ruled") == BLOCK).cast("double"))
    train = settled(train.select("label", *names), "url-features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1).fit(assembler.transform(train))
    scored = trees.transform(assembler.transform(held.withColumns(statistics(overall, False))))
    score = vector_to_array("probability")[1]
    verdict = F.coalesce(F.col("ruled"), F.when(score > 0.5, BLOCK).otherwise(ALLOW))
    return scored.select("id", "host", "path", "rule", verdict.alias("verdict"), score.alias("block_score"))
