"""The dimension registry: which scores a domain has, on which scale, and which of them characterize it."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Domain(NamedTuple):
    prefix: str
    scale: str
    dims: tuple[str, ...]
    characterizing: tuple[str, ...]

    @property
    def names(self) -> list[str]:
        """All dimensions with the domain's prefix, in order."""
        return [f"{self.prefix}_{d}" for d in self.dims]

    @property
    def char_names(self) -> list[str]:
        return [f"{self.prefix}_{d}" for d in self.characterizing]


#: The four domains and their dimensions, in order.
DOMAINS: dict[str, Domain] = {
    "coherence": Domain("co", "1-5", ("topic_coherence", "discourse_structure", "logical_consistency", "temporal_causal_coherence", "mutual_grounding", "overall_coherence_score"), ("topic_coherence", "logical_consistency")),
    "empathy": Domain("em", "1-5", ("emotional_awareness", "emotional_validation", "perspective_taking", "supportive_engagement", "helpful_response", "overall_empathy_score"), ("emotional_awareness", "perspective_taking")),
    "commonsense": Domain("cs", "0-1", ("causality", "consistency", "reaction", "desire", "coherence", "empathy"), ("causality", "consistency", "reaction", "desire")),
    "multicultural": Domain("mu", "0-1", ("cultural_value", "cultural_specificity", "naturalness", "coherence", "empathy"), ("cultural_value", "cultural_specificity")),
}
#: What each dimension asks of a dialogue, by its name without a prefix; domains that share a name share the question.
DESCRIPTIONS: dict[str, str] = {
    "topic_coherence": "how well every turn stays on what the dialogue is about",
    "discourse_structure": "how well turns open, answer and close what others began",
    "logical_consistency": "how free the dialogue is of statements that contradict each other",
    "temporal_causal_coherence": "how well the order of events and their causes fit together",
    "mutual_grounding": "how well speakers show that they have understood each other",
    "overall_coherence_score": "how coherent the dialogue is as a whole",
    "emotional_awareness": "how well a speaker notices what the other one feels",
    "emotional_validation": "how well a speaker accepts the other one's feelings as reasonable",
    "perspective_taking": "how well a speaker sees things from the other one's side",
    "supportive_engagement": "how much care and attention the replies show",
    "helpful_response": "how far the replies help the other one on",
    "overall_empathy_score": "how empathetic the dialogue is as a whole",
    "causality": "how well causes and hindrances of what happens make sense",
    "consistency": "how well speakers act as the persons that they have shown to be",
    "reaction": "how believable the feelings are that events cause",
    "desire": "how well what speakers want follows from what happened",
    "coherence": "how well the turns fit together",
    "empathy": "how well speakers respond to each other's feelings",
    "cultural_value": "how well the talk reflects what the speakers' cultures hold dear",
    "cultural_specificity": "how concretely customs, places and manners of the cultures appear",
    "naturalness": "how much the talk sounds like people of these cultures",
}
ALL_DIMS: list[str] = [n for d in DOMAINS.values() for n in d.names]
#: Which dimension a gold relation speaks to.
RELATION_DIM = {"HinderedBy": "cs_causality", "IsAfter": "cs_causality", "xAttr": "cs_consistency", "xReact": "cs_reaction", "oReact": "cs_reaction", "xWant": "cs_desire", "oWant": "cs_desire"}
#: Turn buckets, sampling weights by bucket, label shares, continuation lengths, split shares.
TURN_BUCKETS = ((2, 6), (7, 10), (11, 16), (17, 999))
SAMPLE_SIZE = 12_800
BUCKET_WEIGHTS = {"coherence": (0.20, 0.25, 0.30, 0.25), "empathy": (0.25, 0.30, 0.30, 0.15)}
LABEL_SHARES = {"Yes": 0.70, "No": 0.30}
CONTINUATION_SHARES = {1: 0.15, 3: 0.40, 5: 0.30, 7: 0.15}
SPLIT_SHARES = {"train": 0.75, "val": 0.10, "test": 0.15}
ROLES = ("user", "assistant")
LABELS = ("global_pass", "global_flip_pass", "target_pass", "target_coarse_pass", "target_flip_pass", "reject")


def domain(name: str) -> Domain:
    return DOMAINS[name]


def by_domain(domain_col: Column, of) -> Column:
    """A different expression for each domain; null for unknown ones."""
    items = list(DOMAINS.items())
    out = F.when(domain_col == items[0][0], of(items[0][1]))
    for name, d in items[1:]:
        out = out.when(domain_col == name, of(d))
    return out


def description_of(dim: Column) -> Column:
    """What a dimension with its domain's prefix asks; null for unknown ones."""
    return F.create_map(*[F.lit(x) for d in DOMAINS.values() for n, bare in zip(d.names, d.dims) for x in (n, DESCRIPTIONS[bare])])[dim]


def names_of(domain_col: Column) -> Column:
    return by_domain(domain_col, lambda d: F.array(*map(F.lit, d.names)))


def char_names_of(domain_col: Column) -> Column:
    return by_domain(domain_col, lambda d: F.array(*map(F.lit, d.char_names)))


def registry_table(spark: SparkSession) -> DataFrame:
    """23 rows: domain, prefix, dim, ord, is_char, scale, description."""
    rows = [(n, d.prefix, f"{d.prefix}_{x}", i, x in d.characterizing, d.scale, DESCRIPTIONS[x]) for n, d in DOMAINS.items() for i, x in enumerate(d.dims)]
    return spark.createDataFrame(rows, "domain string, prefix string, dim string, ord int, is_char boolean, scale string, description string")
