"""Pipeline configuration, source manifests and review records: small JSON files, read strictly."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ChecksumMismatch, InvalidConfig, InvalidManifest, JsonError, ReadError, SizeMismatch
from ..schemas import CADRES, CONFIG, DECISIONS, MANIFEST, OFFICIAL_PREFIX, REPRESENTATIONS, REVIEW

_KINDS = {"string": str, "bigint": int}
_DOMAINS = {"cadre": CADRES, "representation": REPRESENTATIONS, "decision": DECISIONS}


def _read(path: str) -> object:
    try:
        with open(path, encoding="utf-8") as f:
            text = f.read()
    except OSError as e:
        raise ReadError(path, e) from e
    try:
        return json.loads(text)
    except ValueError as e:
        raise JsonError(path, e) from e


def _strict(path: str, value: object, ddl: str) -> dict:
    """The fields of ddl; a missing field, another type or a value outside of its domain is an error."""
    if not isinstance(value, dict):
        raise JsonError(path, "not an object")
    out = {}
    for name, kind in re.findall(r"(\w+) (string|bigint)", ddl):
        x = value.get(name)
        if type(x) is not _KINDS[kind] or (kind == "bigint" and x < 0):
            raise JsonError(path, f"field {name} is missing or no {kind}")
        if name in _DOMAINS and x not in _DOMAINS[name]:
            raise JsonError(path, f"unknown {name} {x}")
        out[name] = x
    return out


def load_manifest(root: str, path: str) -> dict:
    full = os.path.join(root, path)
    return _strict(full, _read(full), MANIFEST)


def load_config(root: str, path: str) -> dict:
    """schema_version, derived_path and pairs; each pair with its two manifests, read once."""
    full = os.path.join(root, path)
    value = _read(full)
    config = _strict(full, value, CONFIG.partition(", pairs")[0])
    if not isinstance(value.get("pairs"), list):
        raise JsonError(full, "field pairs is missing or no list")
    pairs = [_strict(full, p, "cadre string, text string, illustrated string") for p in value["pairs"]]
    if config["schema_version"] != 1:
        raise InvalidConfig("schema_version must be 1")
    cadres, paths = set(), set()
    for p in pairs:
        if p["cadre"] in cadres:
            raise InvalidConfig("duplicate cadre pair")
        cadres.add(p["cadre"])
        for side in REPRESENTATIONS:
            if p[side] in paths:
                raise InvalidConfig("manifest path reused")
            paths.add(p[side])
        p["manifests"] = [load_manifest(root, p[side]) for side in REPRESENTATIONS]
        if any(m["cadre"] != p["cadre"] for m in p["manifests"]):
            raise InvalidConfig("manifest cadre mismatch")
        if [m["representation"] for m in p["manifests"]] != REPRESENTATIONS:
            raise InvalidConfig("invalid representation pair")
    return config | {"pairs": pairs}


def validate_manifest(m: dict) -> None:
    if not m["official_url"].startswith(OFFICIAL_PREFIX):
        raise InvalidManifest(f"official_url must begin with {OFFICIAL_PREFIX}")
    if os.path.isabs(m["local_path"]) or ".." in m["local_path"].split("/"):
        raise InvalidManifest("local_path must stay within the repository")
    date = m["retrieved_at"].encode()
    if len(date) != 10 or date[4:5] != b"-" or date[7:8] != b"-" or not m["page_count"]:
        raise InvalidManifest("invalid retrieval date or page count")
    if not re.fullmatch("[0-9a-fA-F]{64}", m["sha256"]):
        raise InvalidManifest("sha256 must be 64 hexadecimal characters")


#: Files of more bytes than this are hashed as a stream, by the driver: a row would hold all of their content.
STREAMED = 256 << 20


def _found(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """name, file, length and content of every file at or below paths; name is the end of the one of paths."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    parts = [read.load(p).select(F.lit(p.rstrip("/").rpartition("/")[2]).alias("name"), F.col("path").alias("file"), "length", "content") for p in paths]
    return reduce(DataFrame.union, parts)


def _streamed(spark: SparkSession, path: str) -> str:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        return spark._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
    finally:
        stream.close()


def digests(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, byte_size and sha256 of files and folders. path is the end of the given one. A folder has the
    size of all its files, and the hash of their names and hashes in order of name."""
    found = _found(spark, paths)
    long = [(*r, _streamed(spark, r.file)) for r in found.where(F.col("length") > STREAMED).select("name", "file", "length").collect()]
    files = found.where(F.col("length") <= STREAMED).select("name", "file", "length", F.sha2("content", 256).alias("sha256"))
    if long:
        files = files.union(spark.createDataFrame(long, files.schema))
    whole = F.endswith("file", F.concat(F.lit("/"), "name"))
    inner = F.call_function("substring_index", F.col("file"), F.concat(F.lit("/"), "name", F.lit("/")), F.lit(-1))
    rows = files.groupBy("name").agg(
        F.sum("length").alias("byte_size"), (F.bool_and(whole) & (F.count("*") == 1)).alias("one"), F.min("sha256").alias("own"), F.sort_array(F.collect_list(F.struct(inner.alias("file"), "sha256"))).alias("all")
    )
    listed = F.array_join(F.transform("all", lambda x: F.concat(x["file"], F.lit(":"), x["sha256"])), "\n")
    return rows.select(F.col("name").alias("path"), "byte_size", F.when(F.col("one"), F.col("own")).otherwise(F.sha2(listed, 256)).alias("sha256"))


def check_files(spark: SparkSession, expected: DataFrame, paths: Sequence[str]) -> DataFrame:
    """expected (path, byte_size, sha256) with actual_size, actual_sha256 and status.

    Status: ok, missing, size_mismatch or checksum_mismatch. path is the end of a file's or folder's
    path (see digests). Only those of the right size are read and hashed.
    """
    sizes = _found(spark, paths).groupBy(F.col("name").alias("path")).agg(F.sum("length").alias("actual_size"))
    rows = expected.join(sizes, "path", "left")
    same = {r.path for r in rows.where("actual_size = byte_size").select("path").distinct().collect()}
    read = [p for p in paths if p.rstrip("/").rpartition("/")[2] in same]
    hashes = digests(spark, read) if read else spark.createDataFrame([], "path string, byte_size long, sha256 string")
    hashes = hashes.select("path", F.col("sha256").alias("actual_sha256"))
    status = (
        F.when(F.col("actual_size").isNull(), "missing")
        .when(F.col("actual_size") != F.col("byte_size"), "size_mismatch")
        .when(F.col("actual_sha256") != F.col("sha256"), "checksum_mismatch")
        .otherwise("ok")
    )
    return rows.join(hashes, "path", "left").withColumn("status", status)


def verify_sources(spark: SparkSession, root: str, manifests: list[dict]) -> list[dict]:
    """manifests with absolute_path and verified_sha256; the first fault in order raises."""
    out = []
    for m in manifests:
        validate_manifest(m)
        path = os.path.join(root, m["local_path"])
        if not os.path.exists(path):
            raise ReadError(path, "no such file")
        size = os.path.getsize(path)
        if size != m["byte_size"]:
            raise SizeMismatch(path, m["byte_size"], size)
        out.append(m | {"absolute_path": path})
    if out:
        files = spark.read.format("binaryFile").load([m["absolute_path"] for m in out])
        found = {r.path.partition(":")[2].replace("///", "/"): r.sha256 for r in files.select("path", F.sha2("content", 256).alias("sha256")).collect()}
        for m in out:
            m["verified_sha256"] = found[os.path.abspath(m["absolute_path"])]
            if m["verified_sha256"] != m["sha256"]:
                raise ChecksumMismatch(m["absolute_path"], m["sha256"], m["verified_sha256"])
    return out


def config_issues(pairs: DataFrame, manifests: DataFrame) -> DataFrame:
    """code and subject of every fault of pairs (cadre, text, illustrated) against manifests (path,
    cadre, representation): the rules of load_config for many pairs at once."""
    cadres = pairs.groupBy("cadre").count().where("count > 1").select(F.lit("duplicate_cadre").alias("code"), F.col("cadre").alias("subject"))
    uses = pairs.select("cadre", F.explode(F.create_map(F.lit("text"), "text", F.lit("illustrated"), "illustrated")).alias("side", "path"))
    reused = uses.groupBy("path").count().where("count > 1").select(F.lit("manifest_path_reused").alias("code"), F.col("path").alias("subject"))
    found = uses.join(manifests.select("path", F.col("cadre").alias("own_cadre"), "representation"), "path", "left")
    code = (
        F.when(F.col("own_cadre").isNull(), "missing_manifest")
        .when(F.col("own_cadre") != F.col("cadre"), "manifest_cadre_mismatch")
        .when(F.col("representation") != F.col("side"), "invalid_representation")
    )
    return cadres.union(reused).union(found.select(code.alias("code"), F.col("path").alias("subject")).where("code is not null"))


def load_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Review records of all *.json files right in folder, in file order; none if it isn't there."""
    rows = []
    if os.path.isdir(folder):
        for name in sorted(os.listdir(folder)):
            if name.endswith(".json"):
                path = os.path.join(folder, name)
                rows.append(_strict(path, _read(path), REVIEW))
    return spark.createDataFrame(rows, REVIEW)
