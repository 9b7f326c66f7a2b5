"""Label encodings, scan classes and verdicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanlens import constants as K


def attack_exact(label: Column) -> Column:
    return (label == K.ATTACK_LABEL).cast("int")


def attack_trimmed(label: Column) -> Column:
    return F.coalesce((F.trim(label) == K.ATTACK_LABEL).cast("int"), F.lit(0))


def attack_contains(label: Column) -> Column:
    """Case-insensitive substring; NULL is 0."""
    found = F.contains(F.lower(label), F.lit(K.ATTACK_LABEL.lower()))
    return F.coalesce(found.cast("int"), F.lit(0))


def is_recon(label: Column) -> Column:
    return F.coalesce(F.lower(label).rlike(K.RECON_PATTERN), F.lit(False))


def is_benign(label: Column) -> Column:
    return F.coalesce(F.lower(label).rlike(K.BENIGN_PATTERN), F.lit(False))


def verdict_label(prediction: Column) -> Column:
    return F.when(prediction == 1, K.ATTACK_LABEL).otherwise(K.BENIGN_LABEL)


def graded_action(prediction: Column, confidence: Column) -> Column:
    return (
        F.when(prediction == 0, "ALLOW")
        .when(confidence >= K.BLOCK_THRESHOLD, "BLOCK")
        .when(confidence >= K.ALERT_THRESHOLD, "ALERT")
        .otherwise("MONITOR")
    )


def raises_alert(prediction: Column, confidence: Column) -> Column:
    return (prediction == 1) & (confidence >= K.ALERT_THRESHOLD)


def raises_block(prediction: Column, confidence: Column) -> Column:
    return (prediction == 1) & (confidence >= K.BLOCK_THRESHOLD)


def vote_count(scores: list[Column], threshold: float = 0.5) -> Column:
    return reduce(lambda a, b: a + b, [(s >= threshold).cast("int") for s in scores])


def severity(confidence: Column, votes: Column, models: int) -> Column:
    """LOW below .85; MEDIUM from .85 with two models; HIGH above .95 with all of them; NULL without a vote."""
    return (
        F.when(votes == 0, F.lit(None).cast("string"))
        .when((confidence > 0.95) & (votes >= models), "HIGH")
        .when((confidence >= K.BLOCK_THRESHOLD) & (votes >= 2), "MEDIUM")
        .otherwise("LOW")
    )


def tcp_scan_class(flags: Column) -> Column:
    """SYN or STEALTH probe; any other flag set is no probe (NULL)."""
    return F.when(flags == "S", "SYN").when(flags.isin(*K.STEALTH_FLAGS), "STEALTH")


def decoy_profile(port: Column) -> Column:
    names = F.array(*[F.lit(n) for n in K.DECOY_PROFILES])
    return F.element_at(names, (F.pmod(port.cast("long"), F.lit(len(K.DECOY_PROFILES))) + 1).cast("int"))


def scan_type(args: Column, path: Column) -> Column:
    """Scan type from command line and file path.

    The first profile whose ``-s<Letter>`` or ``--name`` occurs wins; explicit
    aggressive options, then a scan delay or "slow" in the path, then "fast" in
    the path override it in that order.
    """
    lowered = F.lower(path)
    first_match = F.lit("unknown")
    for name in reversed([profile[0] for profile in K.SCAN_PROFILES]):
        hit = F.contains(args, F.lit(f"-s{name[0].upper()}")) | F.contains(args, F.lit(f"--{name}"))
        first_match = F.when(hit, name).otherwise(first_match)
    aggressive = F.contains(args, F.lit("aggressive")) | F.contains(args, F.lit("-A "))
    slow = F.contains(lowered, F.lit("slow")) | F.contains(args, F.lit("--scan-delay"))
    fast = F.contains(lowered, F.lit("fast"))
    return (
        F.when(fast & F.contains(lowered, F.lit("very")), "very_fast")
        .when(fast, "fast")
        .when(slow, "slow")
        .when(aggressive, "aggressive")
        .otherwise(first_match)
    )
