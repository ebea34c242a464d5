"""Eligibility, date-of-birth gate and claim lookup."""

from pyspark.sql import functions as F

from ..functions import dob_parts
from .spread import spread_pairs


def eligible_fanout(relationships, members):
    """(party_id, n_memberships): one count instead of one row per membership.

    Memberships are counted per relationship before the join, so neither a busy
    relationship nor a busy party multiplies rows.
    """
    per_relationship = members.groupBy("relationship_id").agg(
        F.count(F.lit(1)).alias("n_members")
    )
    return (
        relationships.join(per_relationship, "relationship_id")
        .groupBy(F.col("party_from_id").alias("party_id"))
        .agg(F.sum("n_members").alias("n_memberships"))
    )


def eligible_parties(parties, relationships, members):
    """Parties with at least one membership, each once.

    Both sides are made distinct first: that shuffles on the join key anyway, and
    repeats of a busy key are dropped before they travel.
    """
    covered = members.select("relationship_id").distinct()
    owners = (
        relationships.join(covered, "relationship_id", "left_semi")
        .select(F.col("party_from_id").alias("party_id"))
        .distinct()
    )
    return parties.join(owners, "party_id", "left_semi")


def dob_keys(dob, prefix="dob"):
    """Array of (part, value) rows: 1 = year, 2 = month, 3 = day of month."""
    return F.array(*[
        F.struct(
            F.lit(part).alias(f"{prefix}_part"), value.alias(f"{prefix}_value")
        )
        for part, value in enumerate(dob_parts(dob), start=1)
    ])


def first_equal_part(part, dob, other_dob):
    """True when ``part`` is the first of year, month, day on which two dates agree.

    Used after joining on one part, this keeps a pair that agrees on several parts
    exactly once.
    """
    (year, month, _), (other_year, other_month, _) = dob_parts(dob), dob_parts(other_dob)
    return (
        (part == 1)
        | ((part == 2) & (year != other_year))
        | ((part == 3) & (year != other_year) & (month != other_month))
    )


def dob_gate_join(left, right, left_dob, right_dob, on=()):
    """Pairs agreeing on year, month or day of month (and on the ``on`` columns).

    The three-way OR becomes an equi join on (part, value): it can be hashed, and a
    busy join key is cut into one piece per year, month and day. A piece with many pairs is
    dealt to several tasks.
    """
    left = left.filter(F.col(left_dob).isNotNull()).select(
        "*", F.inline(dob_keys(F.col(left_dob)))
    )
    right = right.filter(F.col(right_dob).isNotNull()).select(
        "*", F.inline(dob_keys(F.col(right_dob)))
    )
    keys = [*on, "dob_part", "dob_value"]
    return (
        spread_pairs(left, right, keys)
        .filter(first_equal_part(F.col("dob_part"), F.col(left_dob), F.col(right_dob)))
        .drop("dob_part", "dob_value")
    )


def lookup_claims(claims, requests=None, *, claim_id=None, stamp_number=None):
    """Claims asked for by stamp number or claim id.

    Either a frame of requests (request_id, claim_id, stamp_number) or one key. A
    missing key (NULL, 0 or '') is ignored; a request without any key is an error.
    Every matching claim is returned, once per request.
    """
    if requests is None:
        if not claim_id and not stamp_number:
            raise ValueError("Either claim_id or stamp_number must be given")
        hit = F.lit(False)
        if claim_id:
            hit = hit | (F.col("claim_id") == claim_id)
        if stamp_number:
            hit = hit | (F.col("stamp_number") == stamp_number)
        return claims.filter(hit)

    by_id = F.nullif(F.col("claim_id"), F.lit(0))
    by_stamp = F.nullif(F.col("stamp_number"), F.lit(""))
    message = F.lit("Either claim_id or stamp_number must be given in every request")
    no_key = by_id.isNull() & by_stamp.isNull()
    # raised from a join key, which is computed for every request
    wanted = requests.select(
        "request_id",
        F.when(no_key, F.raise_error(message).cast("bigint")).otherwise(by_id).alias("_claim_id"),
        by_stamp.alias("_stamp"),
    )
    same_id = F.col("claim_id") == F.col("_claim_id")
    same_stamp = F.col("stamp_number") == F.col("_stamp")
    # A claim that answers both keys comes from the stamp join only.
    from_stamp = claims.join(wanted, same_stamp)
    from_id = claims.join(wanted, same_id).filter(~F.coalesce(same_stamp, F.lit(False)))
    return from_stamp.unionByName(from_id).select("request_id", *claims.columns)
