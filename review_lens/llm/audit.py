"""How filters that run one after the other interact: every order of them, step by step.

Each document has a mask, one bit for every filter that it fails. A document's fate under
any order follows from its mask, so documents are counted once, in cells of equal part,
mask and labels, at most 4 * 2^filters of them a part. A recursive query then walks all
prefixes of orders: a level extends each prefix by one unused letter, carries the bits
applied so far, joins the part's cells and gives what the new step does to them.

Defined results: a null text is an empty one; a null part is the empty string. A text is
`repeated` for a document whose id is larger than the smallest of the documents with that
text; a null id is neither smaller nor larger, so it never repeats and makes nothing a
repeat. Repeated rows count as often as they come. Of several labels for an id any 1
counts. An empty table has no parts, hence no rows. Other columns are not read.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_lens.llm.common import settled

#: What a step counts: the documents of a cell's `x`, given the bits applied before, that it adds.
_HIT, _BEFORE = "(x.mask & e.bit) <> 0", "(x.mask & w.applied) <> 0"
COUNTS = {
    "kept": "(x.mask & (w.applied | e.bit)) = 0",
    "removed": f"{_HIT} AND NOT {_BEFORE}",
    "redundant": f"{_HIT} AND {_BEFORE}",
    "unique_fails": "x.mask = e.bit",
    "good_lost": f"x.good AND {_HIT} AND NOT {_BEFORE}",
    "toxic_lost": f"x.toxic AND {_HIT} AND NOT {_BEFORE}",
}


def text_failures(text: Column) -> dict[str, Column]:
    """Whether a text fails: few words, few distinct words, many capitals, special marks."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def mask_cells(
    docs: DataFrame,
    labels: DataFrame,
    failures: Callable[[Column], dict[str, Column]],
    id_column="doc_id",
    text_column="text",
    part_column="lang",
) -> DataFrame:
    """(part, mask, good, toxic, n): documents by part, failed filters and labels. The bits of a
    mask are the failures in turn and, last, whether the text is repeated.

    Texts are read once, by the first of the jobs. Whether one is repeated is settled on
    digests: of all documents with a text only those with its smallest id are not, and
    (digest, id) is a key that a text of any frequency is spread over.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    part = F.coalesce(F.col(f"`{part_column}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), part.alias("part"), text.alias("text"))
    fails = failures(F.col("text"))
    mask = F.lit(0)
    for k, failed in enumerate(fails.values()):
        mask = mask + F.when(failed, 1 << k).otherwise(0)
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    slim = settled(rows.select("id", "part", mask.alias("mask"), digest), "audit-masks")
    least = slim.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id"))
    firsts = slim.join(least.withColumn("first", F.lit(True)), ["digest", "id"], "left")
    again = F.col("first").isNull() & F.col("id").isNotNull()
    whole = F.col("mask") + F.when(again, 1 << len(fails)).otherwise(0)
    # Counted per id, so that rows without one are few before they meet the labels.
    counted = firsts.groupBy("id", "part", whole.alias("mask")).agg(F.count(F.lit(1)).alias("n"))
    mark = lambda name: F.coalesce(F.max(F.col(name) == 1), F.lit(False)).alias(name)
    marks = labels.select(F.col(f"`{id_column}`").alias("id"), "quality", "toxic").where("id IS NOT NULL")
    marks = marks.groupBy("id").agg(mark("quality"), mark("toxic"))
    cells = counted.join(marks, "id", "left").groupBy(
        "part",
        "mask",
        F.coalesce("quality", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )
    return settled(cells.agg(F.sum("n").alias("n")), "audit-cells")


def walked(cells: DataFrame, letters: str) -> DataFrame:
    """(part, prefix, step, one column of COUNTS each) of every prefix of every order."""
    spark = cells.sparkSession
    # At most 4 * 2^letters structs a part.
    held = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells"))
    held = settled(held, "audit-parts")
    unused = [
        (applied, 1 << k, letter)
        for applied in range(1 << len(letters))
        for k, letter in enumerate(letters)
        if not applied >> k & 1
    ]
    extensions = spark.createDataFrame(unused, "applied int, bit int, letter string")
    zeros = ", ".join(f"'{name}', 0L" for name in COUNTS)
    added = ", ".join(f"'{name}', a.{name} + if({told}, x.n, 0L)" for name, told in COUNTS.items())
    # Rows grow with the parts, so the recursion has no limit of rows; its depth is that of the letters.
    walk = spark.sql(
        f"""
        WITH RECURSIVE walk(part, prefix, applied, step, found) AS (
          SELECT part, '', 0, 0, named_struct({zeros}) FROM {{held}}
          UNION ALL
          SELECT w.part, concat(w.prefix, e.letter), w.applied | e.bit, w.step + 1,
                 aggregate(c.cells, named_struct({zeros}), (a, x) -> named_struct({added}))
          FROM walk w JOIN {{extensions}} e ON w.applied = e.applied JOIN {{held}} c ON w.part = c.part)
        SELECT part, prefix, step, found.* FROM walk LIMIT ALL
        """,
        held=held,
        extensions=extensions,
    )
    return settled(walk.where("step > 0"), "audit-walk")


def audited(cells: DataFrame, letters: str) -> DataFrame:
    """One row for each part, order of all letters and step; `shapley` sums what the step's
    filter removed over all orders."""
    walk = walked(cells, letters)
    orders = walk.where(F.col("step") == len(letters)).select("part", F.col("prefix").alias("filter_order"))
    steps = orders.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    steps = steps.withColumn("prefix", F.expr("substr(filter_order, 1, step)"))
    rows = steps.join(walk, ["part", "prefix", "step"]).withColumn("letter", F.expr("right(prefix, 1)"))
    shares = rows.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return rows.join(shares, ["part", "letter"]).select("part", "filter_order", "step", *COUNTS, "shapley")


def audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """The five filters: those of `text_failures`, and E for a text that a smaller id has too."""
    return audited(mask_cells(docs, labels, text_failures, **columns), "ABCDE")
