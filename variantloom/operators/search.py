"""Free-text search over nested documents by a stored inverted index.

Every text and number of a document is cut into lower-case tokens of letters and digits, whatever its depth. A document's score
for a query is the sum over the query's distinct tokens of ``2 * weight * n div (n + 1)``: the weight falls with the number of
documents that have the token, and ``n`` is how often the document has it. Whole numbers, so that a tie is a tie."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from variantloom.session import checkpoint_dir
from variantloom.sources.sinks import write_table

_LEFT_OUT = (T.BooleanType, T.BinaryType, T.VariantType, T.NullType)


def tokens_of(text: Column) -> Column:
    """The lower-case tokens of a text, in order; none of a null."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0), F.array().cast("array<string>"))


def text_leaves(kind: T.DataType, path: str = "") -> Iterator[tuple[str, Callable[[Column], Column]]]:
    """(path, function from the value to the array of its texts) for every text or number inside a type."""
    none = F.array().cast("array<string>")
    if isinstance(kind, T.StructType):
        for member in kind.fields:
            for inner, of in text_leaves(member.dataType, f"{path}.{member.name}" if path else member.name):
                yield inner, lambda c, of=of, name=member.name: of(c.getField(name))
    elif isinstance(kind, T.ArrayType):
        for inner, of in text_leaves(kind.elementType, path):
            yield inner, lambda c, of=of: F.coalesce(F.flatten(F.transform(c, lambda x: of(x))), none)
    elif isinstance(kind, T.MapType):
        for end, part, take in (("key", kind.keyType, F.map_keys), ("value", kind.valueType, F.map_values)):
            for inner, of in text_leaves(T.ArrayType(part), f"{path}.{end}"):
                yield inner, lambda c, of=of, take=take: of(take(c))
    elif not isinstance(kind, _LEFT_OUT):
        yield path, lambda c: F.array_compact(F.array(c.cast("string")))


def postings(documents: DataFrame, key: str) -> DataFrame:
    """``token, document, field, frequency``: one row per token, document and path. A document without a key is not found."""
    fields = [
        F.struct(F.lit(path).alias("field"), of(F.col(f"`{f.name}`")).alias("texts"))
        for f in documents.schema.fields for path, of in text_leaves(f.dataType, f.name)]
    rows = documents.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("document"), F.inline(F.array(*fields)))
    found = rows.select("document", "field", F.explode(F.flatten(F.transform("texts", tokens_of))).alias("token"))
    return found.groupBy("token", "document", "field").agg(F.count(F.lit(1)).alias("frequency"))


def part_of_score(weight: Column, frequency: Column) -> Column:
    return F.floor(F.lit(2) * weight * frequency / (frequency + 1))


def write_index(documents: DataFrame, key: str, root: str) -> None:
    """The index at ``root``: ``postings``; ``counts``, added up over the paths of a document; and in ``tokens`` the weight of
    each token and the most it adds to a score."""
    spark = documents.sparkSession
    # ranges of tokens: a search for few tokens skips the other files, a token that most documents have spans several
    placed = lambda rows: rows.repartitionByRange("token", "document").sortWithinPartitions("token", "document")
    write_table(placed(postings(documents, key)), f"{root}/postings")
    write_table(placed(_added_up(_postings(spark, root))), f"{root}/counts")
    total = documents.agg(F.countDistinct(key)).scalar()
    per_token = _counts(spark, root).groupBy("token").agg(F.count(F.lit(1)).alias("documents"), F.max("frequency").alias("most"))
    weighted = per_token.withColumn("weight", F.round(1000 * F.log1p(total / F.col("documents"))).cast("bigint"))
    write_table(weighted.withColumn("most", part_of_score(F.col("weight"), F.col("most"))), f"{root}/tokens")


def _postings(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("token string, document string, field string, frequency bigint").parquet(f"{root}/postings")


def _counts(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("token string, document string, frequency bigint").parquet(f"{root}/counts")


def _added_up(rows: DataFrame) -> DataFrame:
    return rows.groupBy("token", "document").agg(F.sum("frequency").alias("frequency"))


def search(root: str, queries: DataFrame, query: str, text: str, hits: int = 1, fields: Sequence[str] | None = None) -> DataFrame:
    """The ``hits`` best documents of each query: ``query, rank, document, score``; ties go to the smaller document.
    With ``fields`` only tokens under these paths count; weights stay those of whole documents.

    Queries of the same tokens are searched once. First the documents with a query's rarest token are scored. Tokens that even
    together add less than the last of the best found so far need no list of documents: one that has only those cannot get in
    among the best. Only documents of the other tokens are scored as well. So a token that most documents have is read
    document by document only where nothing rarer decides, and yet no hit is lost. A query without a known token has no row."""
    spark = queries.sparkSession
    asked = queries.where(F.col(query).isNotNull()).select(
        F.col(query).alias("query"), F.array_sort(F.array_distinct(tokens_of(F.col(text)))).alias("tokens")).distinct()
    asked = asked.withColumn("wanted", F.sha2(F.array_join("tokens", " "), 256))
    tokens = spark.read.schema("token string, documents bigint, most bigint, weight bigint").parquet(f"{root}/tokens")
    terms = asked.select("wanted", F.explode("tokens").alias("token")).distinct().join(tokens, "token")
    counts = _counts(spark, root) if fields is None else _added_up(_postings(spark, root).where(F.col("field").isin(*fields)))
    out = _best_documents(terms, counts, hits, f"{checkpoint_dir(spark)}/search-{uuid.uuid4().hex}")
    return asked.select("query", "wanted").join(out, "wanted").select("query", "rank", "document", "score")


#: Documents of a rarest token up to which what the other tokens find is searched once for all queries that have these.
SHARED = 64


def _best_documents(terms: DataFrame, counts: DataFrame, hits: int, work: str) -> DataFrame:
    """``wanted, rank, document, score`` for the tokens of each wanted set; ``work`` is a folder for what is read again.

    Queries by a name that few documents have differ in that token only. What their other tokens alone find is one list for all
    of them, as long as the hits and the documents of the rarest token together: without those it still holds enough."""
    spark = terms.sparkSession
    # ordered within a query's own tokens
    rarest = Window.partitionBy("wanted").orderBy("documents", "token")
    write_table(terms.withColumn("place", F.row_number().over(rarest)).withColumn(
        "rest", F.sum("most").over(rarest.rowsBetween(Window.currentRow, Window.unboundedFollowing))), f"{work}/terms")
    terms = spark.read.schema("wanted string, token string, documents bigint, most bigint, weight bigint, place int, rest bigint").parquet(f"{work}/terms")
    listed = counts.select("token", "document")

    def scored(pairs: DataFrame) -> DataFrame:
        each = pairs.join(terms.select("wanted", "token", "weight"), "wanted").join(counts, ["token", "document"])
        return each.groupBy("wanted", "document").agg(F.sum(part_of_score(F.col("weight"), F.col("frequency"))).alias("score"))

    def best(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy("wanted").orderBy(F.col("score").desc(), "document")
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= hits)

    first = scored(terms.where("place = 1").select("wanted", "token").join(listed, "token").select("wanted", "document"))
    write_table(best(first).drop("rank"), f"{work}/found")
    found = spark.read.schema("wanted string, document string, score bigint").parquet(f"{work}/found")
    bound = found.groupBy("wanted").agg(F.when(F.count(F.lit(1)) >= hits, F.min("score")).otherwise(0).alias("bound"))
    needed = terms.where("place > 1").join(bound, "wanted", "left").where(F.col("rest") >= F.coalesce("bound", F.lit(0)))
    few = terms.where((F.col("place") == 1) & (F.col("documents") <= SHARED)).select("wanted")
    own = needed.join(few, "wanted", "left_anti").select("wanted", "token")
    out = found.unionByName(scored(own.join(listed, "token").select("wanted", "document").distinct()))

    others = terms.where("place > 1").join(needed.join(few, "wanted", "left_semi").select("wanted").distinct(), "wanted", "left_semi")
    sets = others.groupBy("wanted").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("token")), " "), 256).alias("_others"))
    write_table(sets, f"{work}/sets")
    sets = spark.read.schema("wanted string, _others string").parquet(f"{work}/sets")
    if not sets.isEmpty():
        rest = others.join(sets, "wanted").select(F.col("_others").alias("wanted"), "token", "documents", "most", "weight").distinct()
        more = _best_documents(rest, counts, hits + SHARED, f"{work}/others").withColumnRenamed("wanted", "_others")
        # a document with the rarest token may come again here with a part of its score
        out = out.unionByName(sets.join(more, "_others").select("wanted", "document", "score"))
    return best(out.groupBy("wanted", "document").agg(F.max("score").alias("score"))).select("wanted", "rank", "document", "score")
