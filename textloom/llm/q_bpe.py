"""Query of the BPE operator."""

from . import bpe

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op10_byte_bpe(spark, sf_dir: str):
    """Every document encoded and decoded: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    import public_tokenizers

    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.encode_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), ranks, public_tokenizers.PATTERN)


QUERIES = {"op10_byte_bpe": op10_byte_bpe}
