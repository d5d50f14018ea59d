"""Schemas of the funnel's tables, declared rather than inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"s": T.StringType(), "d": T.DoubleType(), "l": T.LongType(), "b": T.BooleanType()}


def _schema(text: str) -> T.StructType:
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in (x.split(":") for x in text.split())])


#: Fixed column orders of the stage tables (s string, d double, l long, b boolean).
TABLES = {
    "scores": _schema("compound_id:s path:s"),
    "interaction_filter_report": _schema("compound_id:s passed:s error:s"),
    "reordered_compounds": _schema("compound_id:s winning_pose_index_0based:l distance_A:d"),
    "ranked_hits": _schema("rank:l compound_id:s winning_pose_score:d"),
    "strain_filter_report": _schema("compound_id:s total_TEU:d single_TEU:d flagged:b n_torsions:l strained:b error:s"),
    "final_hits": _schema("rank:l compound_id:s ad4_score:d total_TEU:d single_TEU:d"),
    "bm_group_summary": _schema("bm_group_id:l size:l scaffold_smiles:s"),
    "bm_scaffold_assignment": _schema("compound_id:s bm_group_id:l scaffold_smiles:s"),
    "nested_cluster_assignment": _schema("compound_id:s cluster_id:l"),
    "nested_cluster_summary": _schema("conformation:s threshold:d n_compounds:l n_clusters:l n_singletons:l largest_cluster_size:l mean_cluster_size:d median_cluster_size:d"),
    "q2_cluster_counts": _schema("conformation:s tc:d n_clusters:l"),
    "q3_per_cluster": _schema("conformation:s tc:d cluster_id:l count:l mean_z:d min_z:d std_z:d trustworthy:b"),
    "q4_per_cluster": _schema("conformation:s tc:d cluster_id:l count:l mean_z:d min_z:d std_z:d t_stat:d p_value:d good:b"),
    "qualifying_singletons": _schema("conformation:s compound_id:s ad4_score:d z:d"),
    "q5_mmgbsa_input_list": _schema("conformation:s source:s cluster_id:l compound_id:s ad4_score:d cluster_size:l roles:s"),
    "mmgbsa_part": _schema("compound_id:s conformation:s cluster_id:l role:s source:s ad4_score:d mmgbsa_dg:d error:s"),
    "mmgbsa_results": _schema("rank:l compound_id:s mmgbsa_dg:d ad4_score:d cluster_id:l role:s source:s"),
}
