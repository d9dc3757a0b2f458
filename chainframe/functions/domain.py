"""Column functions of the domain: validators, dataset references, versions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What names and hashes look like.
PATTERNS = {
    "block_hash": "^0x[a-z0-9]{64}",
    "address": "^0x[a-fA-F0-9]{40}$",
    "dataset_namespace": "^[a-z0-9_]+$",
    "dataset_name": "^[a-z_][a-z0-9_]*$",
    "dataset_hash": "^[0-9a-fA-F]{64}$",
    "dataset_tag": "^(latest|dev)$",
    "dataset_kind": "^(manifest|evm-rpc|eth-beacon|firehose)$",
    "dataset_reference": r"^[a-z0-9_]+/[a-z_][a-z0-9_]*@.+$",
    "user_id": "^(c[a-z0-9]{24}|did:privy:c[a-z0-9]{24})$",
    "token_duration": r"(?i)^-?\d+\.?\d*\s*(sec|secs|second|seconds|s|minute|minutes|min|mins|m|hour|hours|hr|hrs|h|day|days|d|week|weeks|w|year|years|yr|yrs|y)(\s+ago|\s+from\s+now)?$",
}
SEMVER = r"^(0|[1-9]\d*)\.(0|[1-9]\d*)\.(0|[1-9]\d*)(?:-((?:0|[1-9]\d*|\d*[a-zA-Z-][0-9a-zA-Z-]*)(?:\.(?:0|[1-9]\d*|\d*[a-zA-Z-][0-9a-zA-Z-]*))*))?(?:\+([0-9a-zA-Z-]+(?:\.[0-9a-zA-Z-]+)*))?$"
MOST_DESCRIPTION = 1024


def is_valid(kind: str, value: Column) -> Column:
    return value.rlike(PATTERNS[kind])


def is_semver(value: Column) -> Column:
    return value.rlike(SEMVER)


def is_revision(value: Column) -> Column:
    return value.isin("latest", "dev") | is_semver(value) | is_valid("dataset_hash", value)


def dataset_ref(ref: Column) -> Column:
    """struct(namespace, name, revision): the first / ends the namespace (_ without one), the last @ starts the revision (dev without one)."""
    namespace = F.when(F.contains(ref, F.lit("/")), F.substring_index(ref, "/", 1)).otherwise("_")
    rest = F.regexp_replace(ref, "^[^/]*/", "")
    rest = F.when(F.contains(ref, F.lit("/")), rest).otherwise(ref)
    at = F.contains(rest, F.lit("@"))
    return F.struct(
        namespace.alias("namespace"),
        F.when(at, F.regexp_replace(rest, "@[^@]*$", "")).otherwise(rest).alias("name"),
        F.when(at, F.substring_index(rest, "@", -1)).otherwise("dev").alias("revision"),
    )


def format_ref(namespace: Column, name: Column, revision: Column) -> Column:
    return F.concat(namespace, F.lit("/"), name, F.lit("@"), revision)


def semver(value: Column) -> Column:
    """struct(major, minor, patch, release, prerelease, build); a release sorts after its prereleases. Null if it is no version."""
    part = lambda i: F.regexp_extract(value, SEMVER, i)
    return F.when(
        is_semver(value),
        F.struct(part(1).cast("long").alias("major"), part(2).cast("long").alias("minor"), part(3).cast("long").alias("patch"), (part(4) == "").alias("release"), part(4).alias("prerelease"), part(5).alias("build")),
    )


def pkce_challenge(verifier: Column) -> Column:
    """base64url of the SHA-256 of a verifier, without padding."""
    return F.rtrim(F.translate(F.base64(F.unhex(F.sha2(verifier, 256))), "+/=", "-_ "))
