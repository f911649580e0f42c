"""Speaker roles: who speaks as an expert on what."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.lineage import cut
from threadloom.operators.skew import broadcast_if_small

PARTICIPANT = "Participant"  # fixed value: role of untagged speakers


def tag_speakers(messages: DataFrame, ontology: DataFrame) -> DataFrame:
    """Add ``roles`` from an ontology (speaker, role); several roles per speaker.

    Roles are gathered per speaker first, so messages are neither multiplied nor
    regrouped.
    """
    roles = ontology.groupBy(F.col("speaker").alias("sender")).agg(
        F.sort_array(F.collect_set("role")).alias("roles")
    )
    roles = broadcast_if_small(cut(roles, "speaker-roles"))
    return messages.join(roles, "sender", "left").withColumn(
        "roles", F.coalesce("roles", F.array(F.lit(PARTICIPANT)))
    )
