"""Named queries over the sample tables, one per operator and job."""

from pyspark.sql import functions as F

from . import fixtures as fx
from .functions import (
    display_name,
    dob_distance,
    dob_parts,
    dob_text,
    fragment_columns,
    levenshtein_sql,
    levenshtein_strict,
    match_score,
    name_alias,
    name_distance,
    nysiis,
    remove_special_chars,
    split_tokens,
    strip_name_suffix,
    total_distance,
)
from .operators import (
    apply_alias_rules,
    contains_join,
    distinct_fragments,
    dob_gate_join,
    eligible_fanout,
    eligible_parties,
    fragment_union,
    index_changed,
    index_new_rows,
    index_stale,
    index_unchanged,
    lookup_claims,
    match_rank,
    top_n,
)
from .plans import claim_search, duplicates, entity_index, entity_search, party_index
from .sources import check_constraints, publish_index, read_index, seed_entities
from .storage import durable, new_folder

#: Rows that the top_candidates query keeps per search; the limit is its feature.
TOP_CANDIDATES = 20


# --- inputs -----------------------------------------------------------------

def load_parties(spark, d):
    covered = fx.members(spark, d).distinct().withColumn("is_member", F.lit(True))
    return (
        fx.parties(spark, d)
        .join(fx.relationships(spark, d), F.col("party_id") == F.col("party_from_id"), "left")
        .join(covered, "relationship_id", "left")
        .select("party_id", "first_name", "last_name", "dob", "relationship_id",
                F.coalesce("is_member", F.lit(False)).alias("is_member"))
    )


def seeded_entities(spark, d):
    rows = fx.names(spark, d).filter(F.col("w1").isNotNull()).select(
        F.col("lang").alias("entity_type"), F.col("w1").alias("entity_value1"),
        F.col("w2").alias("entity_value2"), F.lit("documents").alias("source_table"),
        F.col("doc_id").alias("source_key"),
    )
    return seed_entities(spark, rows)


def claim_requests(spark, d):
    """One request per claim: by id, by the stamp of the next claim, or by both."""
    cid = F.col("claim_id")
    next_stamp = F.concat(F.lit("PC"), F.lpad((cid - 999999).cast("string"), 7, "0"))
    return fx.claims(spark, d).select(
        cid.alias("request_id"),
        F.when(cid % 3 != 0, cid).otherwise(0).alias("claim_id"),
        F.when(cid % 3 == 0, F.col("stamp_number"))
        .when(cid % 3 == 1, next_stamp).otherwise("").alias("stamp_number"),
    )


def claims_looked_up(spark, d):
    return lookup_claims(fx.claims(spark, d), claim_requests(spark, d))


# --- entity index and search --------------------------------------------------

def entity_index_of(spark, d):
    return entity_index.build_entity_index(fx.entities(spark, d))


def indexed_entities(spark, d):
    """Entities, derived once and written down, and their index."""
    entities = durable(fx.entities(spark, d))
    return entities, entity_index.build_entity_index(entities)


def encoded_entities(spark, d):
    return entity_index.encode_entities(fx.entities(spark, d))


def preview(spark, d):
    raw = fragment_union(encoded_entities(spark, d), "entity_id", "code1", "code2")
    return entity_index.index_preview(raw.drop("variant"))


def published_index(spark, d):
    return read_index(spark, publish_index(entity_index_of(spark, d))).index


def constraint_report(spark, d):
    """Entities of all labelled documents, named or not, against the full index."""
    named = durable(fx.names(spark, d))
    index = durable(entity_index.build_entity_index(fx.entities(spark, d, named)))
    labelled = fx.table(spark, d, "labels").select("doc_id").distinct()
    rows = named.join(labelled, "doc_id", "left_semi").select(
        F.col("doc_id").alias("entity_id"), F.col("lang").alias("entity_type"),
        F.col("w1").alias("entity_value1"), F.col("w2").alias("entity_value2"),
        F.lit("documents").alias("source_table"), F.col("doc_id").alias("source_key"),
    )
    return check_constraints(rows, index)


def entity_matches(spark, d):
    return entity_search.find_entity_matches(fx.terms(spark, d), *indexed_entities(spark, d))


def stored_entity_matches(spark, d):
    """The search of a published index."""
    entities, index = indexed_entities(spark, d)
    # the rows of an entity stay together, so that its best match is found before the shuffle
    stored = read_index(spark, publish_index(index, spread_by=["entity_id"]))
    return entity_search.find_entity_matches(fx.terms(spark, d), entities, stored)


def prepared_entity_matches(spark, d):
    """The large-batch form of the search, whatever the number of terms."""
    prepared = entity_search.prepare_entity_search(*indexed_entities(spark, d))
    best = entity_search.search_prepared(entity_search.encoded_terms(fx.terms(spark, d)), prepared)
    return entity_search.with_distance(best).drop("search_term")


def term_hits(spark, d):
    encoded = entity_search.encoded_terms(fx.terms(spark, d))
    return contains_join(encoded, indexed_entities(spark, d)[1]).drop("search_term")


def best_fragments(spark, d):
    encoded = entity_search.encoded_terms(fx.terms(spark, d))
    return entity_search.best_fragment_per_entity(entity_search.matched_rows(encoded, *indexed_entities(spark, d)))


# --- party index ---------------------------------------------------------------

def people(spark, d):
    """Parties, relationships and members; the parties are derived once and written down."""
    return durable(fx.parties(spark, d)), fx.relationships(spark, d), fx.members(spark, d)


def expected_rows(spark, d):
    return party_index.expected_party_rows(*people(spark, d))


def party_refresh(spark, d):
    everyone = people(spark, d)
    return party_index.refresh_party_index(
        *everyone, fx.old_party_index(spark, d, everyone[0]), fx.NEW_USER
    )


def compared(compare):
    """A comparison of the expected rows and an old index of the same parties."""
    def run(spark, d):
        everyone = people(spark, d)
        return compare(party_index.expected_party_rows(*everyone), fx.old_party_index(spark, d, everyone[0]))

    return run


def all_party_fragments(spark, d):
    encoded = party_index.encode_parties(fx.parties(spark, d))
    return fragment_union(encoded, "party_id", "first_code", "last_code")


# --- claim search ----------------------------------------------------------------

def searches_and_parties(spark, d):
    everyone = people(spark, d)
    index = party_index.build_party_index(*everyone, fx.NEW_USER)
    encoded = claim_search.encode_claims(fx.claims(spark, d, everyone[0]))
    return encoded, claim_search.prepare_party_search(*everyone, index)


def searched_pairs(spark, d):
    encoded, prepared = searches_and_parties(spark, d)
    return claim_search.candidate_pairs(claim_search.distinct_searches(encoded), prepared)


def party_scores(spark, d):
    return claim_search.scored_candidates(searched_pairs(spark, d)).select(
        "search_id", "party_id", "weight", "types", "cnt", "score"
    )


def totals(spark, d):
    return claim_search.totals_per_pair(searched_pairs(spark, d))


def party_matches(spark, d):
    everyone = people(spark, d)
    index = party_index.build_party_index(*everyone, fx.NEW_USER)
    return claim_search.find_party_matches(fx.claims(spark, d, everyone[0]), *everyone, index)


def literal_party_matches(spark, d):
    everyone = people(spark, d)
    index = party_index.build_party_index(*everyone, fx.NEW_USER)
    return claim_search.find_party_matches(
        fx.claims(spark, d, everyone[0]), *everyone, index, keep_empty_codes=True
    )


def stored_party_matches(spark, d):
    """Search a stored index that was never refreshed: other members, variants and fields."""
    everyone = people(spark, d)
    stored = read_index(spark, publish_index(fx.old_party_index(spark, d, everyone[0])))
    return claim_search.find_party_matches(fx.claims(spark, d, everyone[0]), *everyone, stored.index)


def refreshed_party_matches(spark, d):
    """Refresh a stored index, store the result and search that."""
    everyone = people(spark, d)
    old = fx.old_party_index(spark, d, everyone[0])
    refreshed = party_index.refresh_party_index(*everyone, old, fx.NEW_USER)[0]
    stored = read_index(spark, publish_index(refreshed))
    return claim_search.find_party_matches(fx.claims(spark, d, everyone[0]), *everyone, stored.index)


def stored_party_scores(spark, d):
    everyone = people(spark, d)
    prepared = claim_search.prepare_party_search(*everyone, fx.old_party_index(spark, d, everyone[0]))
    searches = claim_search.distinct_searches(claim_search.encode_claims(fx.claims(spark, d, everyone[0])))
    return claim_search.scored_candidates(claim_search.candidate_pairs(searches, prepared)).select(
        "search_id", "party_id", "weight", "types", "cnt", "score"
    )


def dob_gated(spark, d):
    """Claims and eligible parties of one name whose dates of birth pass the gate."""
    everyone = people(spark, d)
    claims = fx.claims(spark, d, everyone[0]).select(
        "claim_id", F.upper("patient_last_name").alias("name"), "patient_dob"
    )
    members = eligible_parties(*everyone).select(
        "party_id", F.upper("last_name").alias("name"), "dob"
    )
    return dob_gate_join(claims, members, "patient_dob", "dob", on=["name"])


def own_party(spark, d):
    """Every claim next to the party it was made from."""
    claims = fx.claims(spark, d).withColumn("party_id", F.col("claim_id") - 1000000)
    return claims.join(fx.parties(spark, d), "party_id")


def name_distances(spark, d):
    return own_party(spark, d).select(
        "claim_id",
        name_distance("first_name", "last_name", "patient_first_name",
                      "patient_last_name").alias("distance"),
    )


def dob_distances(spark, d):
    return own_party(spark, d).select(
        "claim_id", dob_distance("dob", "patient_dob").alias("distance")
    )


def total_distances(spark, d):
    names = name_distance("first_name", "last_name", "patient_first_name", "patient_last_name")
    counted = own_party(spark, d).join(
        eligible_fanout(fx.relationships(spark, d), fx.members(spark, d)), "party_id"
    )
    score = match_score(F.lit("0.900"), F.lit(2), F.col("n_memberships"))
    return counted.select(
        "claim_id",
        total_distance(names, dob_distance("dob", "patient_dob"), score).alias("total_distance"),
    )


def match_scores(spark, d):
    """Score of every party, field and weight as if a search hit all its rows."""
    everyone = people(spark, d)
    grouped = expected_rows(spark, d).groupBy("party_id", "weight").agg(
        F.count_distinct("name_field_id").alias("types"), F.count(F.lit(1)).alias("n")
    )
    counted = grouped.join(eligible_fanout(*everyone[1:]), "party_id")
    hits = F.col("n") * F.col("n_memberships")
    return counted.select(
        "party_id", "weight", match_score("weight", "types", hits).alias("score")
    )


# --- texts -----------------------------------------------------------------------

def words(spark, d):
    """Distinct blank-separated words of all documents, and the names in other tables."""
    # repeats within a text are dropped before they become rows
    of_text = F.array_distinct(F.split("text", "[ \n]+"))
    texts = fx.table(spark, d, "documents").select(F.explode(of_text).alias("name"))
    for source, column in (("customer", "c_name"), ("supplier", "s_name"), ("part", "p_name"),
                           ("pages", "url")):
        texts = texts.unionByName(fx.table(spark, d, source).select(F.col(column).alias("name")))
    return texts.distinct()


def cleaned_texts(spark, d):
    allowed = F.when(F.col("lang") == "en", " |,").otherwise(".| |xy")
    return fx.table(spark, d, "documents").select(
        "doc_id",
        remove_special_chars("text").alias("plain"),
        remove_special_chars("text", "|^ ^,", "^").alias("with_extra"),
        remove_special_chars("text", allowed, "|").alias("by_language"),
    )


def full_names(spark, d):
    """Display names followed by one of many endings, suffix or not."""
    endings = ["", " I", " ii", " III", " iv", " VI", ", Jr", " SR.", " md", ", PhD", " JR ", " V",
               "II", ", Sr.", " Phd.", " IVI"]
    ending = F.element_at(F.array(*map(F.lit, endings)),
                          (F.col("doc_id") % len(endings) + 1).cast("int"))
    return fx.names(spark, d).select(
        "doc_id", F.concat(display_name("w1", "w2"), ending).alias("name")
    )


def tokens(spark, d):
    rows = fx.table(spark, d, "conversations").select(
        "conv_id", "turn", F.explode(split_tokens("text", ".")).alias("value")
    )
    other = fx.table(spark, d, "part").select(
        F.col("p_partkey").alias("conv_id"), F.lit(-1).cast("bigint").alias("turn"),
        F.explode(split_tokens("p_name", "")).alias("value"),
    )
    whole = fx.table(spark, d, "pages").select(
        F.col("page_id").alias("conv_id"), F.lit(-2).cast("bigint").alias("turn"),
        F.explode(split_tokens("url", "//")).alias("value"),
    )
    return rows.unionByName(other).unionByName(whole)


def fragments_of_words(spark, d):
    codes = words(spark, d).select(nysiis("name").alias("code")).distinct()
    return codes.select("code", *[c.alias(v) for v, c in fragment_columns("code").items()])


def lenient_distances(spark, d):
    left = F.when(F.col("doc_id") % 9 == 4, "").otherwise(F.col("w1"))
    right = F.when(F.col("doc_id") % 9 == 5, "  ").otherwise(F.concat(F.col("w2"), F.lit("  ")))
    return fx.names(spark, d).select("doc_id", levenshtein_sql(left, right).alias("distance"))


def strict_distances(spark, d):
    parts = fx.table(spark, d, "part").select(
        F.lit("part").alias("source"), F.col("p_partkey").alias("id"),
        levenshtein_strict("p_name", "p_type").alias("distance"),
    )
    customers = fx.table(spark, d, "customer").select(
        F.lit("customer").alias("source"), F.col("c_custkey").alias("id"),
        levenshtein_strict("c_name", "c_mktsegment").alias("distance"),
    )
    orders = fx.table(spark, d, "orders").select(
        F.lit("orders").alias("source"), F.col("o_orderkey").alias("id"),
        levenshtein_strict("o_orderpriority", "o_orderstatus").alias("distance"),
    )
    return parts.unionByName(customers).unionByName(orders)


def dates(spark, d):
    shipped = fx.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("dob")
    )
    born = fx.parties(spark, d).select(
        F.col("party_id").alias("l_orderkey"), F.lit(0).alias("l_linenumber"), "dob"
    )
    return shipped.unionByName(born)


def date_parts(spark, d):
    year, month, day = dob_parts("dob")
    return dates(spark, d).select(
        "l_orderkey", "l_linenumber",
        year.alias("year"), month.alias("month"), day.alias("day"),
    )


def aliases(spark, d):
    last, first = name_alias("patient_last_name", "patient_first_name")
    return fx.claims(spark, d).select("claim_id", last.alias("last_name"), first.alias("first_name"))


def aliases_by_rules(spark, d):
    """Claims after a rule per party: the longest matching prefix names another person."""
    everyone = people(spark, d)[0]
    applied = apply_alias_rules(
        fx.claims(spark, d, everyone), fx.alias_rules(spark, d, everyone), "patient_last_name", "patient_first_name"
    )
    return applied.select(
        "claim_id", F.col("patient_last_name").alias("last_name"), F.col("patient_first_name").alias("first_name")
    )


# --- duplicates ---------------------------------------------------------------------

def clusters(spark, d):
    return duplicates.duplicate_clusters(fx.entities(spark, d))


def merged_duplicates(spark, d):
    entities = durable(fx.entities(spark, d))
    return duplicates.merge_duplicates(entities, duplicates.duplicate_clusters(entities), with_members=True)


def clusters_by_steps(spark, d):
    """Clusters of copies and near names, into which the links of equal codes are merged."""
    entities = durable(duplicates.with_name(fx.entities(spark, d)))
    names = durable(duplicates.distinct_names(entities))
    near = duplicates.near_names(names).select("left_id", "right_id")
    alone = names.select(F.col("name_id").alias("entity_id"), F.col("name_id").alias("cluster_id"))
    stored = duplicates.merge_links(alone, near)[0]
    merged = durable(duplicates.merge_links(stored, duplicates.same_code_names(names))[0])
    by_name = names.join(merged.withColumnRenamed("entity_id", "name_id"), "name_id")
    return duplicates.per_entity(entities, by_name, "cluster_id")


def stored_refresh(spark, d):
    """A stored index, refreshed in place."""
    folder, everyone = new_folder(spark, "party-index"), people(spark, d)
    party_index.store_party_index(fx.old_party_index(spark, d, everyone[0]), folder)
    party_index.refresh_stored_index(*everyone, folder, fx.NEW_USER)
    return party_index.read_party_index(spark, folder)


QUERIES = {
    "load_entities": fx.entities,
    "seed_entities": seeded_entities,
    "load_parties": load_parties,
    "lookup_claims": claims_looked_up,
    "index_preview": preview,
    "publish_entity_index": published_index,
    "merge_party_index": lambda s, d: party_refresh(s, d)[0],
    "check_constraints": constraint_report,
    "entity_index_join": lambda s, d: entity_search.entity_index_join(*indexed_entities(s, d)),
    "contains_join": term_hits,
    "dob_gate_join": dob_gated,
    "eligible_fanout": lambda s, d: eligible_fanout(*people(s, d)[1:]),
    "eligible_parties": lambda s, d: eligible_parties(*people(s, d)),
    "index_new_rows": compared(index_new_rows),
    "index_unchanged": compared(index_unchanged),
    "index_changed": compared(index_changed),
    "index_stale": compared(index_stale),
    "remove_special_chars": cleaned_texts,
    "strip_name_suffix": lambda s, d: full_names(s, d).select(
        "doc_id", strip_name_suffix("name").alias("stripped")),
    "nysiis": lambda s, d: words(s, d).select("name", nysiis("name").alias("code")),
    "split_to_rows": tokens,
    "code_fragments": fragments_of_words,
    "levenshtein_sql": lenient_distances,
    "levenshtein_strict": strict_distances,
    "dob_text": lambda s, d: dates(s, d).select(
        "l_orderkey", "l_linenumber", dob_text("dob").alias("dob_text")),
    "dob_parts": date_parts,
    "display_name": lambda s, d: fx.entities(s, d).select(
        "entity_id", display_name("entity_value1", "entity_value2").alias("display_name")),
    "name_distance": name_distances,
    "dob_distance": dob_distances,
    "total_distance": total_distances,
    "name_alias": aliases,
    "name_alias_rules": aliases_by_rules,
    "match_score": match_scores,
    "party_scores": party_scores,
    "best_total_distance": lambda s, d: totals(s, d).select(
        "search_id", "party_id", "last_name", "first_name", "dob", "total_distance"),
    "distinct_fragments": lambda s, d: distinct_fragments(
        encoded_entities(s, d), "entity_id", "code1", "code2"),
    "best_fragment_per_entity": best_fragments,
    "match_rank": lambda s, d: match_rank(totals(s, d)).select(
        "search_id", "party_id", "total_distance", "rank"),
    "sorted_matches": lambda s, d: entity_search.sorted_matches(entity_matches(s, d)),
    "top_candidates": lambda s, d: claim_search.limited_candidates(searched_pairs(s, d), TOP_CANDIDATES).select(
        "search_id", "party_id", "weight", "score"),
    "top_n": lambda s, d: top_n(totals(s, d)).select(
        "search_id", "party_id", "total_distance", "rank"),
    "fragment_union": all_party_fragments,
    "build_entity_index": entity_index_of,
    "build_entity_index_by_name": lambda s, d: entity_index.build_entity_index(indexed_entities(s, d)[0], by_name=True),
    "expected_rows_by_name": lambda s, d: party_index.expected_party_rows(*people(s, d), by_name=True),
    "refresh_stored_index": stored_refresh,
    "refresh_party_index": lambda s, d: party_refresh(s, d)[1],
    "find_entity_matches": entity_matches,
    "find_entity_matches_prepared": prepared_entity_matches,
    "find_entity_matches_stored": stored_entity_matches,
    "encoded_terms": lambda s, d: entity_search.encoded_terms(fx.terms(s, d)),
    "find_party_matches": party_matches,
    "find_party_matches_literal": literal_party_matches,
    "find_party_matches_stored": stored_party_matches,
    "find_party_matches_refreshed": refreshed_party_matches,
    "party_scores_stored": stored_party_scores,
    "duplicate_pairs": lambda s, d: duplicates.duplicate_pairs(fx.entities(s, d)),
    "duplicate_clusters": clusters,
    "duplicate_clusters_by_steps": clusters_by_steps,
    "merge_duplicates": merged_duplicates,
}
