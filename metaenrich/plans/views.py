"""A deterministic view of metadata records over the order keys, for queries and benchmarks."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rules import Rules, load_rules
from ..sources.corpus import configure
from ..sources.scratch import spread

#: Free-text resource types: exact, typo, camel case, split, near miss, redundant, nonsense, blank, punctuation.
LABELS = (
    "Data paper", "Dataset", "Softwre", "physicalObject", "bo k", "t xt", "Text", "Datasets", "modell", "Peer, Review!",
    "otput managment plan", "A heap of old stones", "   ", "---", "Pre-print", "HTMLPageModel", "OTHER", "otehr", "Work flow", "Study_Registration",
    "peer reveiw", "Computational Notebook", "imge", "phisical objct", "Conference proceedingss", "Output Management Plann", "Presentaton", "Soundd", "", "Audio/Visual",
)
#: Members that no edit may touch: order of keys, spelling of numbers, escapes.
OTHER = r'"ris":"GEN","z":{"b":1.0,"a":[-0.0,1e2,1.10,"\u00e9\/"]}'
GENERAL = ("Text", "Other", None, "Image", "Dataset")
SUFFIXES = ("alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa")
RULES_FILE = Path(__file__).resolve().parents[2] / "configs" / "reclassification_rules.yaml"


def shipped_rules() -> Rules:
    return load_rules(RULES_FILE)


def large_references(rules: Rules) -> tuple[str, ...]:
    """More references than are compared one by one: each of the rules' ones as several kinds."""
    return tuple(f"{value} {suffix}" for value in rules.reference_values for suffix in SUFFIXES)


def pick(values: tuple, k: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (k % len(values)).cast("int"))


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers' keys (c_custkey), dealt to all tasks: their table has few row groups, and what is made of a key is costly."""
    return spread(spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey"))


def label_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(x,) for x in LABELS], "t string")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, value): a JSON line a key. Every 17th is malformed, every 13th has a number as resource type, every 11th no id."""
    configure(spark)
    k = F.col("k")
    doi = F.when(k % 11 != 0, F.concat(F.lit('"id":"10.5555/'), k.cast("string"), F.lit('",'))).otherwise(F.lit(""))
    free = F.when(k % 13 == 0, F.lit("7")).otherwise(F.concat(F.lit('"'), pick(LABELS, k), F.lit('"')))
    general = F.coalesce(F.concat(F.lit('"'), pick(GENERAL, k), F.lit('"')), F.lit("null"))
    first = F.concat(F.lit('"resourceTypeGeneral":'), general, F.lit(f",{OTHER},\"resourceType\":"), free)
    absent = F.concat(F.lit(f'{OTHER},"resourceType":'), free)
    types = F.concat(F.lit("{"), F.when(k % 7 == 0, absent).otherwise(first), F.lit("}"))
    types = F.when(k % 19 == 0, F.lit('"none"')).otherwise(types)
    line = F.concat(F.lit("{"), doi, F.lit('"attributes":{"types":'), types, F.lit("}}"))
    return keys(spark, sf_dir).select("k", F.concat(line, F.when(k % 17 == 0, F.lit(" xyz")).otherwise(F.lit(""))).alias("value"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct free texts (t): types and names of the parts, and the labels as the orders have them."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.explode(F.array("p_type", "p_name")).alias("t"))
    return part.union(keys(spark, sf_dir).select(pick(LABELS, F.col("k")).alias("t"))).distinct()


def organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organisations of a registry dump, one a supplier: two names and a funder number each."""
    s = F.col("s_suppkey").cast("string")
    name = lambda value, kind: F.struct(value.alias("value"), F.array(F.lit(kind)).alias("types"))
    names = F.array(name(F.concat(F.lit("Inst "), s), "alias"), name(F.concat(F.lit("Institute of Topic "), s, F.lit(" Studies")), "ror_display"))
    fund = F.concat(F.lit("10000"), s)
    external = F.array(F.struct(F.lit("fundref").alias("type"), F.array(fund).alias("all"), fund.alias("preferred")))
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.concat(F.lit("https://ror.example/"), s).alias("id"), names.alias("names"), external.alias("external_ids"), F.lit("active").alias("status"))


def lookup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON line a customer (value), with creators' affiliations and funders: some known, misspelt, repeated or unknown."""
    configure(spark)
    c = F.col("c_custkey")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    doi = F.when(c % 11 != 0, text('"id":"10.1/', c, '",')).otherwise("")
    spelt = text('"', F.when(c % 3 == 0, "Institut").otherwise("Institute"), " of Topic ", c % 60, ' Studies"')
    known = text('{"name":"Inst ', c % 60, '"', F.when(c % 2 == 0, ',"affiliationIdentifier":"x"').otherwise(""), "}")
    creators = text('[{"name":"A', c, '","affiliation":[', spelt, ',{"name":"College ', c % 7, '","place":', c % 5, "},", known, ",", spelt, ']},{"name":"B","affiliation":[]}]')
    funder = F.when(c % 4 != 0, text('{"funderName":"Inst ', c % 60, '","funderIdentifier":"https://doi.org/10.13039/10000', c % 90, '","funderIdentifierType":"Crossref Funder ID"}')).otherwise(text('{"funderName":"Nobody ', c % 3, '"}'))
    line = text("{", doi, '"attributes":{"creators":', creators, ',"fundingReferences":[', funder, "]}}")
    return customers(spark, sf_dir).select(line.alias("value"))
