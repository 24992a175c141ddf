"""Exact and canonical duplicates with a ranked keeper, editions of one work, and how much of their paragraphs these share.

What decides is shuffled without texts: digests, row numbers and sort keys. Documents are decided by row: rows of a
repeated version_id are apart, and validation() counts them.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.functions import text as fn
from textloom.functions.batches import short_batches
from textloom.functions.shingles import Shingler, Signer
from textloom.schema import PART_OR_VOLUME, tier_rank
from textloom.store import stage

#: Characters of a canonical paragraph that counts.
PARAGRAPH = 80
#: Tasks among which the rows of one digest are dealt.
SALTS = 16
#: Sets and shingles of a block of near_pairs(), on average at most.
BLOCK_SETS, BLOCK_SHINGLES = 256, 500_000
SORT = ("author", "work_id", "source_id", "version_id")


def _text(c):
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def sort_key():
    """Tier, then author, work, source and version, nulls as empty."""
    return F.struct(tier_rank(F.col("quality_tier")).alias("tier"), *[_text(c).alias(c) for c in SORT])


def with_digests(documents):
    """documents with text_sha256 and canonical_text_sha256. A null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.withColumns({"text_sha256": F.sha2(text, 256), "canonical_text_sha256": F.sha2(fn.canonical(text), 256)})


def paragraph_hashes(documents, keys=("version_id",), separator: str | None = None, least: int = PARAGRAPH):
    """(*keys, paragraph_hash): the distinct digests of each document's canonical paragraphs of so many characters or more."""
    parts = documents.select(*keys, F.explode(fn.paragraphs(F.coalesce("text", F.lit("")), *([separator] if separator else []))).alias("p"))
    canonical = parts.select(*keys, fn.canonical(F.col("p")).alias("p")).where(F.length("p") >= least)
    return canonical.select(*keys, F.sha2("p", 256).alias("paragraph_hash")).distinct()


def groups(hashed, digest: str, member: str = "version_id"):
    """(digest, size, members) of digests that several rows have, members in keeper order. Of a group's members only ids and sort keys are gathered."""
    out = hashed.groupBy(F.col(digest).alias("hash")).agg(F.count("*").alias("size"), F.sort_array(F.collect_list(F.struct(sort_key().alias("k"), F.col(member).alias("id")))).alias("m")).where("size > 1")
    return out.select("hash", "size", F.transform("m", lambda x: x["id"]).alias("members"))


def exact_decisions(hashed, row: str = "_ord"):
    """(row, version_id, text_sha256, keeper, kept, group_size) of every row: the first by sort key, then by row, is kept.

    The keeper is found by an aggregate, which combines before its shuffle, and not by a window, which would gather a
    group in one task. It is joined back by digest and salt, so that a group of a third of all rows is dealt to SALTS
    tasks; digests that one row has aren't joined at all.
    """
    key = F.struct(sort_key().alias("k"), F.col(row).alias("row"), F.col("version_id").alias("version_id"))
    first = hashed.groupBy("text_sha256").agg(F.min(key).alias("first"), F.count("*").alias("size")).where("size > 1")
    first = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = hashed.select(row, "version_id", "text_sha256", F.pmod(F.xxhash64(row), F.lit(SALTS)).cast("int").alias("salt")).join(first, ["text_sha256", "salt"], "left")
    keeper = F.when(F.col("first").isNull(), F.col("version_id")).otherwise(F.col("first.version_id"))
    return rows.select(row, "version_id", "text_sha256", keeper.alias("keeper"), F.coalesce(F.col(row) == F.col("first.row"), F.lit(True)).alias("kept"), F.coalesce("size", F.lit(1)).alias("group_size"))


def canonical_review(hashed):
    """(hash, size, texts) of canonical digests that several texts share: more than white space and case apart."""
    return hashed.groupBy(F.col("canonical_text_sha256").alias("hash")).agg(F.count("*").alias("size"), F.count_distinct("text_sha256").alias("texts")).where("size > 1 and texts > 1")


def clusters(kept):
    """(work_id, language, size, relation) of works with several kept documents in one language; a null work is none, a null language one."""
    title = fn.canonical(F.coalesce("title", F.lit("")))
    part = F.regexp_like(_text("title"), F.lit(PART_OR_VOLUME))
    rows = kept.select(_text("work_id").alias("work_id"), _text("language").alias("language"), F.when(_text("title") != "", title).alias("t"), _text("translator").alias("translator"), part.alias("part"))
    out = rows.where("work_id != ''").groupBy("work_id", "language").agg(F.count("*").alias("size"), F.count_distinct("translator").alias("translators"), F.count_distinct("t").alias("titles"), F.max("part").alias("part")).where("size > 1")
    relation = (
        F.when(F.col("part") & (F.col("translators") <= 1), "multi_part_or_volume_candidate")
        .when(F.col("part"), "multi_part_or_volume_with_translator_variance")
        .when(F.col("translators") > 1, "alternate_translation_or_scope_candidate")
        .when(F.col("titles") <= 1, "alternate_edition_candidate")
        .otherwise("same_work_alternate_candidate")
    )
    return out.select("work_id", "language", "size", relation.alias("relation"))


def containment(hashes, group=("work_id", "language"), member: str = "version_id"):
    """(*group, max_containment): the largest share of the smaller document's paragraphs that two of a group's documents have in common; 0 without any.

    hashes is stored once, and read from there. Documents of equal sets of paragraphs are one, and make their group's
    share 1. The others meet by shared paragraphs, so that the work follows what is shared and not the pairs of a group.
    """
    h = stage(hashes.select(*group, member, "paragraph_hash").distinct(), "paragraphs")
    # a sum of hashes stands for a set: nothing is gathered
    sets = h.groupBy(*group, member).agg(F.count("*").alias("n"), *[F.sum(F.pmod(F.xxhash64("paragraph_hash", F.lit(i)), F.lit(1 << 40))).alias(f"s{i}") for i in (0, 1)])
    sets = stage(sets.groupBy(*group, "n", "s0", "s1").agg(F.min(member).alias(member), F.count("*").alias("equal")), "paragraph-sets")
    alike = sets.groupBy(*group).agg(F.max("equal").alias("equal"))
    same = lambda *on: [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in on]
    rows = h.alias("l").join(sets.alias("r"), same(*group, member)).select("l.*", "r.n").join(alike.where("equal = 1").select(*[F.col(c).alias(f"__{c}") for c in group]), [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in group], "left_semi")
    one, other = (rows.withColumnsRenamed({c: f"{c}_{x}" for c in rows.columns}) for x in "ab")
    met = [F.col(f"{c}_a") == F.col(f"{c}_b") for c in (*group, "paragraph_hash")]
    pairs = one.join(other, met).where(F.col(f"{member}_a") < F.col(f"{member}_b")).groupBy(*[F.col(f"{c}_a").alias(f"__{c}") for c in group], f"{member}_a", f"{member}_b")
    most = pairs.agg((F.count("*") / F.min(F.least("n_a", "n_b"))).alias("m")).groupBy(*[f"__{c}" for c in group]).agg(F.max("m").alias("m"))
    out = alike.join(most, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in group], "left")
    null_group = F.array_contains(F.array(*[F.col(c).isNull() for c in group]), True)
    return out.select(*group, F.when((F.col("equal") > 1) & ~null_group, 1.0).otherwise(F.coalesce("m", F.lit(0.0))).alias("max_containment"))


def deduplicate(documents, row: str = "_ord", separator: str | None = None):
    """(kept, rejected). kept: documents with a struct deduplication; rejected: the others with reject_reason and keeper.

    documents: version_id, work_id, source_id, author, title, translator, language, quality_tier, text and a row number.
    Digests are stored once, in narrow rows, and so are decisions: texts meet these once, by row.
    """
    named = [c for c in documents.columns if c not in ("text", "deduplication")]
    hashed = stage(with_digests(documents).select(*named, "text_sha256", "canonical_text_sha256"), "digests")
    decisions = exact_decisions(hashed, row).select(F.col(row).alias("__row"), "keeper", "kept", "group_size")
    decided = stage(hashed.join(decisions, hashed[row] == F.col("__row")), "decided")
    kept = decided.where("kept")
    gone = decided.where("NOT kept").groupBy(F.col("text_sha256").alias("__sha")).agg(F.sort_array(F.collect_list(F.struct(sort_key().alias("k"), "version_id"))).alias("__gone"))
    found = clusters(kept).select(F.col("work_id").alias("__work"), F.col("language").alias("__lang"), "size", "relation")
    texts = documents.join(kept.select("__row"), documents[row] == F.col("__row"), "left_semi")
    counts = paragraph_hashes(texts, (row,), separator).groupBy(F.col(row).alias("__r")).agg(F.count("*").cast("int").alias("__n"))
    out = kept.join(gone, F.col("text_sha256") == F.col("__sha"), "left").join(found, (_text("work_id") == F.col("__work")) & (_text("language") == F.col("__lang")), "left").join(counts, kept[row] == F.col("__r"), "left")
    struct = F.struct(
        F.when(F.col("group_size") > 1, "accepted_exact_duplicate_keeper").otherwise("accepted_unique").alias("status"),
        "text_sha256",
        "canonical_text_sha256",
        F.coalesce("__n", F.lit(0)).alias("paragraph_hash_count"),
        F.coalesce(F.transform("__gone", lambda x: x["version_id"]), F.array().cast("array<string>")).alias("exact_duplicate_version_ids"),
        F.col("relation").isNotNull().alias("same_work_review"),
        F.col("relation").alias("same_work_relation"),
        F.coalesce(F.col("size"), F.lit(1)).cast("int").alias("same_work_cluster_size"),
    )
    about = out.select("__row", struct.alias("__about"))
    accepted = documents.join(about, documents[row] == F.col("__row")).select(*[documents[c] for c in documents.columns if c != "deduplication"], F.col("__about").alias("deduplication"))
    why = decided.where("NOT kept").select("__row", F.lit("exact_duplicate").alias("reject_reason"), "keeper")
    return accepted, documents.join(why, documents[row] == F.col("__row")).select(*[documents[c] for c in documents.columns], "reject_reason", "keeper")


def validation(deduplicated):
    """One row of counts: records, distinct ids (null is a value), digests that several have, rows with the struct."""
    distinct = lambda c: (F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).cast("bigint")
    sha = F.col("deduplication.text_sha256")
    repeated = deduplicated.groupBy(sha.alias("sha")).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("exact_duplicate_hash_groups"))
    counts = deduplicated.agg(F.count("*").alias("records"), F.coalesce(distinct("doc_id"), F.lit(0)).alias("unique_doc_ids"), F.coalesce(distinct("version_id"), F.lit(0)).alias("unique_version_ids"), F.count("deduplication").alias("records_with_dedup_metadata"))
    return counts.join(F.broadcast(repeated))  # broadcast: one row each


def cross_source_overlap(hashed):
    """(source_a, source_b, shared): how many canonical digests two sources have in common."""
    h = hashed.select("source", "canonical_text_sha256").distinct()
    pairs = h.groupBy("canonical_text_sha256").agg(F.array_sort(F.collect_set("source")).alias("s")).where("size(s) > 1")
    one = pairs.select("s", F.posexplode("s").alias("i", "source_a"))
    return one.select("source_a", F.explode(F.slice("s", F.col("i") + 2, F.size("s"))).alias("source_b")).groupBy("source_a", "source_b").agg(F.count("*").alias("shared"))


def _near_sketch(words: int, bands: int, rows: int):
    """Of (k, digest, text): (k, digest, n, bands), or the set of hashes in place of its bands where there are none to find. Texts without words are left out."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        shingle, signer = Shingler(words), Signer(bands, rows) if bands else None
        for batch in batches:
            out = []
            for k, digest, text in zip(batch.column(0), batch.column(1), batch.column(2)):
                s = shingle(" ".join(text.as_py().split()))
                if len(s):
                    out.append((k, digest, len(s), signer.bands(s) if signer else s.astype(np.uint64).tobytes()))
            if out:
                k, digest, n, last = zip(*out)
                columns = [pa.array([x.as_py() for x in k], batch.column(0).type), pa.array([x.as_py() for x in digest], pa.string()), pa.array(n, pa.int64()), pa.array(last, pa.list_(pa.int64()) if signer else pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["k", "digest", "n", "last"])

    return run


def _near_within(similarity: float):
    """Of the sets (k, one, other, body) of two blocks: (a, b, jaccard) of similar sets of the one and the other. Those of one block with itself are both."""
    import numpy as np
    import pyarrow as pa

    def run(table):
        keys, one, other = (table.column(c).to_pylist() for c in ("k", "one", "other"))
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("body")]
        right = sorted((i for i in range(len(sets)) if other[i]), key=lambda i: len(sets[i]))
        size = np.array([len(sets[i]) for i in right])
        found = []
        if right:
            _, codes = np.unique(np.concatenate(sets), return_inverse=True)
            at = np.split(codes, np.cumsum([len(x) for x in sets])[:-1])
            flat, starts = np.concatenate([at[i] for i in right]), np.concatenate([[0], np.cumsum(size)])
            flag = np.zeros(codes.max() + 1, np.int32)
            for i in range(len(sets)):
                if not one[i]:
                    continue
                n = len(sets[i])
                # a set of another size can't be similar; rounding is left to the last test
                low, high = np.searchsorted(size, n * similarity - 1), np.searchsorted(size, n / similarity + 1, "right")
                if low >= high:
                    continue
                flag[at[i]] = 1
                common = np.add.reduceat(flag[flat[starts[low] : starts[high]]], starts[low:high] - starts[low])
                flag[at[i]] = 0
                jaccard = common / (n + size[low:high] - common)
                for j in np.flatnonzero(jaccard >= similarity):
                    r = right[low + j]
                    if i != r and not (one[r] and other[i] and keys[i] > keys[r]) and keys[i] != keys[r]:
                        found.append((min(keys[i], keys[r]), max(keys[i], keys[r]), float(jaccard[j])))
        kind = table.column("k").type
        a, b, jaccard = zip(*found) if found else ((), (), ())
        return pa.table([pa.array(a, kind), pa.array(b, kind), pa.array(jaccard, pa.float64())], ["a", "b", "jaccard"])

    return run


def near_pairs(documents, key: str = "doc_id", words: int = 5, similarity: float = 0.8, hashes: int = 64, rows: int = 4, block_sets: int = BLOCK_SETS, block_shingles: int = BLOCK_SHINGLES):
    """(a, b, jaccard): pairs of documents whose sets of word shingles are similar, by bands of minimal and maximal hashes, confirmed on the whole sets.

    Documents of one text are one: the smallest key stands for them. A document's group is the smallest key in its
    bands; groups are dealt to blocks of bounded size. Blocks that have a band in common are compared as a whole, so
    that neither candidate pairs nor sets are multiplied by a group's members, but by its blocks.
    """
    spark = documents.sparkSession
    short_batches(spark)
    kind = dict(documents.select(F.col(key).alias("k")).dtypes)["k"]
    texts = documents.where(F.col("text").isNotNull()).select(F.col(key).alias("k"), F.sha2("text", 256).alias("digest"), F.lower("text").alias("text"))
    sketches = texts.mapInArrow(_near_sketch(words, hashes // rows, rows), f"k {kind}, digest string, n bigint, last array<bigint>")
    # by a digest: of the rows of one text the first key's stays
    nodes = sketches.groupBy("digest").agg(F.min(F.struct("k", "n", "last")).alias("x")).select("digest", "x.k", "x.n", F.col("x.last").alias("bands"))
    nodes = stage(nodes, "near-nodes")
    banded = nodes.select("k", "digest", "n", F.explode("bands").alias("band"))
    heads = banded.groupBy("band").agg(F.min("k").alias("head"), F.count("*").alias("members")).where("members > 1").select("band", "head")
    met = stage(banded.join(heads.hint("merge"), "band"), "near-met")
    label = met.groupBy("k", "digest", "n").agg(F.min("head").alias("label"))
    parts = label.groupBy("label").agg(F.ceil(F.greatest(F.count("*") / block_sets, F.sum("n") / block_shingles)).alias("parts"))
    blocks = label.join(parts.hint("merge"), "label").select("k", "digest", F.xxhash64("label", F.pmod(F.xxhash64("digest"), "parts")).alias("block"))
    blocks = stage(blocks, "near-blocks")
    within = met.join(blocks.hint("merge"), ["k", "digest"]).groupBy("band", "block").agg(F.count("*").alias("members"))
    # of one band only blocks are gathered
    of_band = within.groupBy("band").agg(F.sort_array(F.collect_list(F.struct("block", "members"))).alias("x"))
    at = of_band.select("x", F.posexplode("x").alias("i", "l")).select("l", F.explode(F.slice("x", F.col("i") + 1, F.size("x"))).alias("r"))
    couples = at.where("l.block != r.block OR l.members > 1").select(F.col("l.block").alias("l"), F.col("r.block").alias("r")).distinct()
    couples = stage(couples, "near-couples")
    sides = couples.select("l", "r", F.explode(F.array_distinct(F.array("l", "r"))).alias("block"))
    wanted = blocks.join(sides.select("block").distinct().hint("merge"), "block", "left_semi")
    bodies = texts.join(wanted.select("k", "digest").hint("merge"), ["k", "digest"], "left_semi")
    bodies = bodies.mapInArrow(_near_sketch(words, 0, 0), f"k {kind}, digest string, n bigint, body binary").dropDuplicates(["k", "digest"])
    bodies = stage(bodies.join(blocks.hint("merge"), ["k", "digest"]).select("k", "block", "body"), "near-sets")
    dealt = bodies.join(sides.hint("merge"), "block").select("l", "r", "k", (F.col("block") == F.col("l")).alias("one"), (F.col("block") == F.col("r")).alias("other"), "body")
    return dealt.groupBy("l", "r").applyInArrow(_near_within(similarity), f"a {kind}, b {kind}, jaccard double")
