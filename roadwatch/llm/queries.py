"""The operators of this folder as queries over the given tables."""

from pyspark.sql import functions as F

from roadwatch.llm.align import token_alignment
from roadwatch.llm.block_names import exact_duplicates
from roadwatch.llm.hilbert import document_shards
from roadwatch.llm.host_paths import main_text
from roadwatch.llm.line_chunks import line_report
from roadwatch.llm.mixing import mix
from roadwatch.llm.near import near_duplicates
from roadwatch.llm.personal import personal_data
from roadwatch.llm.quality import quality
from roadwatch.llm.ranked import ranked_documents
from roadwatch.llm.scoring import text_scores
from roadwatch.llm.suffixes import byte_report
from roadwatch.llm.tokens import encode


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def chosen_paths(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir)).drop("group", "key_1", "key_2")


def hilbert_shards(spark, sf_dir):
    return document_shards(documents(spark, sf_dir))


def host_paths(spark, sf_dir):
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def personal_spans(spark, sf_dir):
    return personal_data(documents(spark, sf_dir)).drop("found")


def weak_supervision(spark, sf_dir):
    judged = quality(documents(spark, sf_dir))
    return judged.withColumn("chance_of_good", F.round("chance_of_good", 6))


def line_chunks(spark, sf_dir):
    return line_report(documents(spark, sf_dir))


def piece_tokens(spark, sf_dir):
    return encode(documents(spark, sf_dir))


def source_mix(spark, sf_dir):
    return mix(documents(spark, sf_dir))


def suffix_arrays(spark, sf_dir):
    return byte_report(documents(spark, sf_dir))


def block_naming(spark, sf_dir):
    return exact_duplicates(documents(spark, sf_dir))


def presence_masks(spark, sf_dir):
    return ranked_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def subword_lattice(spark, sf_dir):
    return text_scores(documents(spark, sf_dir))


def spill_counting(spark, sf_dir):
    return token_alignment(documents(spark, sf_dir))


QUERIES = {
    "op1_chosen_paths": chosen_paths,
    "op2_hilbert_shards": hilbert_shards,
    "op3_host_paths": host_paths,
    "op4_weak_supervision": weak_supervision,
    "op5_personal_spans": personal_spans,
    "op6_line_chunks": line_chunks,
    "op7_piece_tokens": piece_tokens,
    "op8_source_mix": source_mix,
    "op9_suffix_arrays": suffix_arrays,
    "op10_block_naming": block_naming,
    "op11_presence_masks": presence_masks,
    "op12_subword_lattice": subword_lattice,
    "op13_spill_counting": spill_counting,
}
