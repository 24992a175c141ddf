"""From documents to token ids: quality, repeated passages, near duplicates, mixture, encoding."""

from textloom.llm import bpe, line_dedup, mixing, near_dedup, quality
from textloom.llm._store import stage
from textloom.llm.q_bpe import VOCABULARY


def keep_quality(spark, docs, sf_dir):
    """Documents that the quality classifier doesn't reject. Learns from labels of the documents it is given."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_passages(spark, docs, sf_dir):
    """Texts without runs of 50 words or more that occur in an earlier document; documents of which nothing is left go."""
    return line_dedup.deduplicate(docs)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group that shingles of five words link at a similarity of 0.8 or more."""
    return near_dedup.deduplicate(docs, words=5, num=80, den=100)


def mix_sources(spark, docs, sf_dir):
    """Documents as often as the mixture of sources takes them: not, once or twice."""
    return mixing.mixed(docs)


def encode(spark, docs, sf_dir):
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids of each row."""
    import public_tokenizers

    return bpe.encode_digests(docs, bpe.load_ranks(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_passages),
    ("minhash near-dedup", drop_near_duplicates),
    ("source mixing", mix_sources),
    ("byte-level bpe", encode),
]

#: Several stages (the classifier, the encoder) can't be put in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over documents, each stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"), spark)
    return STAGES[-1][1](spark, docs, sf_dir)
