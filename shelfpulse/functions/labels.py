"""Category labels for review text."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The label set, in the order that also breaks ties.
CATEGORIES = ("画面", "剧情", "玩法", "音效", "优化", "价格", "情怀", "其他")
FALLBACK = "其他"

# Words that point at a label. A deployment passes its own table.
DEFAULT_RULES: dict[str, tuple[str, ...]] = {
    "画面": ("画面", "画质", "美术", "建模", "光影", "graphics", "visual"),
    "剧情": ("剧情", "故事", "结局", "角色", "台词", "story", "plot"),
    "玩法": ("玩法", "操作", "战斗", "关卡", "难度", "gameplay", "combat"),
    "音效": ("音效", "音乐", "配乐", "配音", "声音", "sound", "music"),
    "优化": ("优化", "卡顿", "闪退", "掉帧", "延迟", "crash", "bug"),
    "价格": ("价格", "打折", "便宜", "太贵", "性价比", "price", "discount"),
    "情怀": ("情怀", "童年", "回忆", "经典", "怀旧", "nostalgia", "classic"),
}


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def label_by_rules(
    text: Column | str,
    rules: Mapping[str, Iterable[str]] | None = None,
    labels: Sequence[str] = CATEGORIES,
    fallback: str = FALLBACK,
) -> Column:
    """The label with the most distinct words found in ``text``, whatever their case.

    Ties go to the earlier label, no hit gives ``fallback``. The rules become one
    expression over the row, so labelling needs neither a join nor a shuffle.
    """
    rules = DEFAULT_RULES if rules is None else rules
    unknown = set(rules) - set(labels)
    if unknown:
        raise ValueError(f"rules for labels outside the set: {sorted(unknown)}")
    column = F.lower(_col(text))
    scored = []
    for label in labels:
        words = list(dict.fromkeys(word.lower() for word in rules.get(label, ())))
        if words:
            hits = [F.contains(column, F.lit(word)).cast("int") for word in words]
            scored.append((label, F.coalesce(reduce(lambda a, b: a + b, hits), F.lit(0))))
    # Struct order compares hits first, then the negated rank of the label. Without hits the
    # fallback, which stands before all labels, is the largest.
    candidates = [(F.lit(0), 1, fallback)]
    candidates += [(hits, -rank, label) for rank, (label, hits) in enumerate(scored)]
    scores = [
        F.struct(hits.alias("hits"), F.lit(rank).alias("rank"), F.lit(label).alias("label"))
        for hits, rank, label in candidates
    ]
    return F.array_max(F.array(*scores))["label"]


def labels_by(
    make_model: Callable[[], Callable[[pd.Series], Iterable[str]]],
    labels: Sequence[str] = CATEGORIES,
    fallback: str = FALLBACK,
) -> Callable[[Column | str], Column]:
    """Wrap a user's own batch model as a column function.

    ``make_model`` runs once per task, its result once per Arrow batch with the whole
    texts of that batch. Only the text column travels to Python. Answers outside the label
    set become ``fallback``.
    """
    allowed, other = frozenset(labels), fallback

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_model()
        for texts in batches:
            answers = [a.strip() if isinstance(a, str) else a for a in model(texts)]
            if len(answers) != len(texts):
                raise ValueError("the model must answer once per text")
            yield pd.Series([a if a in allowed else other for a in answers], dtype="object")

    return F.pandas_udf(run, "string")
