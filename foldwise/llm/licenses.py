"""Licence scans with a trained paragraph classifier, in Spark expressions only.

Paragraphs are runs of lines that hold a letter or digit, so a bare comment
sign ends one like a blank line.  Those with a licence cue word are cut into
windows of words over their line breaks, and once more line by line, so that
a notice on a line of its own is seen without its neighbours.  A window's
one- and two-word n-grams are hashed to sparse features, and a multinomial logistic regression gives the licence
family or ``unknown``.  The probability a family needs is calibrated on
held-back unknown windows.  A prediction stands only if the window holds
enough of the word triples of one of that family's templates; a template of
two words is held as that pair.

Training labels come from the templates: windows that hold a template are
of its family, windows that hold almost none of any are unknown, as are
those of paragraphs without a cue word.  At most ``max_rows`` labelled windows
of each of the three sorts are used, the unknown ones of at most ``max_texts``
texts a sort (chosen by hash, documented bounds for the classifier).  Every whole
text is scanned; windows are cut only where a gram of a template begins, as no
other window can be confirmed.

Defined cases: a null text has no paragraphs; a paragraph without a cue
word is unknown; repeated rows are scanned alike; without any labelled
window in the data the templates alone train the families; ties go to the
family that is listed first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: licence families and phrases of their public notices (fixed values)
TEMPLATES = [
    ("MIT", "released under the mit license"),
    ("MIT", "licensed under the mit license"),
    ("MIT", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "licensed under the apache license version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("GPL", "this work is licensed under the gnu general public license version 3"),
    ("GPL", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("LGPL", "under the terms of the gnu lesser general public license"),
    ("AGPL", "under the terms of the gnu affero general public license"),
    ("BSD", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("BSD", "licensed under the bsd license"),
    ("MPL-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0"),
    ("CC-BY-NC", "licensed under cc by nc 4.0"),
    ("CC-BY-NC", "licensed under a creative commons attribution noncommercial 4.0 international license"),
    ("CC-BY-SA", "licensed under cc by sa 4.0"),
    ("CC-BY-SA", "licensed under a creative commons attribution sharealike 4.0 international license"),
    ("CC-BY", "licensed under cc by 4.0"),
    ("CC-BY", "licensed under a creative commons attribution 4.0 international license"),
    ("CC0", "to the extent possible under law the author has waived all copyright and related rights"),
    ("ISC", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "this is free and unencumbered software released into the public domain"),
    ("All-rights-reserved", "all rights reserved no part of this publication may be reproduced"),
    # short public forms
    ("MIT", "mit license"),
    ("Apache-2.0", "apache license version 2.0"),
    ("Apache-2.0", "apache license 2.0"),
    ("Apache-2.0", "apache 2.0 license"),
    ("GPL", "gnu general public license"),
    ("GPL", "gnu gpl"),
    ("LGPL", "gnu lesser general public license"),
    ("LGPL", "gnu lgpl"),
    ("AGPL", "gnu affero general public license"),
    ("AGPL", "gnu agpl"),
    ("BSD", "bsd license"),
    ("MPL-2.0", "mozilla public license version 2.0"),
    ("MPL-2.0", "mozilla public license 2.0"),
    ("CC-BY-NC", "cc by nc 4.0"),
    ("CC-BY-NC", "creative commons attribution noncommercial 4.0"),
    ("CC-BY-SA", "cc by sa 4.0"),
    ("CC-BY-SA", "creative commons attribution sharealike 4.0"),
    ("CC-BY", "cc by 4.0"),
    ("CC-BY", "creative commons attribution 4.0"),
    ("CC0", "cc0 1.0"),
    ("ISC", "isc license"),
    ("Unlicense", "the unlicense"),
    ("All-rights-reserved", "all rights reserved"),
]
_GAP = "[^a-z0-9]+"
CUES = (f"licen[cs]e|copyright|permission|redistribut|public{_GAP}domain|creative{_GAP}commons|free{_GAP}software|all{_GAP}rights|warrant|"
        f"gnu|cc0|cc{_GAP}by")
FAMILIES = list(dict.fromkeys(f for f, _ in TEMPLATES))
UNKNOWN = "unknown"
#: words of a window and between two starts; features; shares of a template's
#: triples that confirm a prediction, and that label a window
WINDOW, STEP, BUCKETS = 24, 12, 4096
CONFIRM, LABEL, NONE = 0.6, 0.8, 0.2


def _bucket(expr: str) -> str:
    return f"int(pmod(xxhash64({expr}), {BUCKETS}))"


def _grams(words: str) -> str:
    """Distinct word triples of an array of words (shorter arrays: all words as one)."""
    n = f"greatest(size({words}) - 2, 0)"
    return (f"if(size({words}) < 3, array(array_join({words}, ' ')), array_distinct(zip_with(zip_with(slice({words}, 1, {n}), slice({words}, 2, {n}), "
            f"(a, b) -> concat(a, ' ', b)), slice({words}, 3, {n}), (a, b) -> concat(a, ' ', b))))")


def _held_grams(words: str) -> str:
    """What a window holds: its distinct word triples and pairs."""
    n = f"greatest(size({words}) - 1, 0)"
    return f"array_union({_grams(words)}, zip_with(slice({words}, 1, {n}), slice({words}, 2, {n}), (a, b) -> concat(a, ' ', b)))"


def _features(words: str) -> str:
    n = f"greatest(size({words}) - 1, 0)"
    return (f"array_distinct(concat(transform({words}, a -> {_bucket('a')}), "
            f"zip_with(slice({words}, 1, {n}), slice({words}, 2, {n}), (a, b) -> {_bucket('a, b')})))")


#: numbers of the windows of the words ``ws``
_STARTS = f"sequence(0, int(greatest(0, ceil((size(ws) - {WINDOW}) / {STEP}))))"
_WORD_SPLIT = r"regexp_extract_all(lower(x), '[a-z0-9]+(?:[.][0-9]+)*', 0)"


#: paragraphs of the lines ``_lines``: each line behind a mark and its number, a
#: line without letters and digits as the other mark, which ends a paragraph
_PARAGRAPHS = r"""filter(split(concat('\n', array_join(transform(_lines, (x, i) -> if(x rlike '[\\p{L}\\p{N}]',
    concat(i, char(2), translate(x, concat(char(1), char(2)), '  ')), char(1))), '\n')), char(1)), x -> instr(x, char(2)) > 0)"""


#: grams that lie in a template: a window without any of them is unknown
_LINE_GRAMS = sorted({" ".join(w[i:i + n]) for _, t in TEMPLATES for w in [t.split()] for n in [min(3, len(w))] for i in range(len(w) - n + 1)})


def _windows(df: DataFrame, text: str, cue: bool = True, near: bool = False) -> DataFrame:
    """``df`` with ``_win``: (number of the paragraph's first line, words) windows of
    the paragraphs with a cue word (``cue=False``: without one); ``near``: only
    windows in which a gram of a template begins."""
    body = F.coalesce(F.col(text), F.lit(""))
    has = f"lower(x.t) rlike '{CUES}'"
    d = df.withColumn("_lines", F.when(F.lower(body).rlike(CUES) if cue else F.lit(True), F.split(body, "\n")).otherwise(F.array().cast("array<string>")))
    d = d.withColumn("_para", F.expr(rf"""transform({_PARAGRAPHS}, x -> struct(int(regexp_extract(x, '\n([0-9]+)\\x02', 1)) as p,
        regexp_replace(x, '\n[0-9]+\\x02', '\n') as t))"""))
    grams = ", ".join(f"'{g}'" for g in _LINE_GRAMS)
    places = (f"filter(sequence(0, size(ws) - 1), i -> concat(get(ws, i), ' ', get(ws, i + 1)) in ({grams}) "
              f"or concat(get(ws, i), ' ', get(ws, i + 1), ' ', get(ws, i + 2)) in ({grams}))")
    starts = (f"flatten(transform(array({places}), ps -> filter({_STARTS}, i -> exists(ps, a -> a >= i * {STEP} and a < i * {STEP} + {WINDOW}))))"
              if near else _STARTS)
    # line breaks end no window of the whole paragraph; those of a line by itself count with
    # the paragraph, and a paragraph of one line is cut once
    return d.withColumn("_win", F.expr(f"""array_distinct(flatten(transform(filter(_para, x -> {has if cue else f'not ({has})'}), y ->
        flatten(transform(if(size(split(y.t, '\n')) > 2, concat(array(y.t), split(y.t, '\n')), array(y.t)), x -> flatten(transform(array({_WORD_SPLIT}),
            ws -> if(size(ws) = 0, array(), transform({starts}, i -> struct(y.p as p, slice(ws, i * {STEP} + 1, {WINDOW}) as w)))))))))) """))


def _literal(values: np.ndarray) -> str:
    """An array of doubles as a constant; Spark folds it once."""
    return "cast(split('" + ",".join(f"{v:.5g}" for v in values) + "', ',') as array<double>)"


def _templates() -> str:
    rows = [f"named_struct('f', {FAMILIES.index(f) + 1}, 'g', {_grams('split(' + repr(t) + ', chr(32))')})" for f, t in TEMPLATES]
    return f"array({', '.join(rows)})"


def _every_gram() -> str:
    """The grams of all templates; a window without any of them is unknown."""
    return f"array_distinct(flatten(transform({_templates()}, t -> t.g)))"


def _held(family: str, grams: str) -> str:
    """Largest share of the triples of one of the family's templates in ``grams``."""
    return (f"coalesce(array_max(transform(filter(_tpl, t -> {family}), t -> size(array_intersect(t.g, {grams})) / size(t.g))), 0D)")


@dataclass
class Model:
    """Weights (families and unknown last, by bucket; the bias at the end) and the
    probability that a family needs."""

    weights: np.ndarray
    threshold: float


def _train(features: list[np.ndarray], target: np.ndarray, classes: int, steps: int = 200, decay: float = 1e-4) -> np.ndarray:
    """Multinomial logistic regression on sparse rows, full-batch Adagrad.  A
    row's features weigh 1 / sqrt(their number); classes weigh alike."""
    size = np.array([len(f) for f in features])
    idx = np.concatenate(features) if len(features) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(features)), size)
    val = (1 / np.sqrt(size))[row]
    order = np.argsort(idx, kind="stable")
    keys, begin = np.unique(idx[order], return_index=True)
    share = np.bincount(target, minlength=classes)
    cost = (1 / np.maximum(share, 1))[target]
    cost = cost / cost.sum()
    w, b = np.zeros((BUCKETS, classes)), np.zeros(classes)
    sw, sb = np.full((BUCKETS, classes), 1e-10), np.full(classes, 1e-10)
    starts = np.cumsum(size) - size
    for _ in range(steps):
        z = np.add.reduceat(w[idx] * val[:, None], starts, axis=0) + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(target)), target] -= 1
        p *= cost[:, None]
        g = np.add.reduceat((p[row] * val[:, None])[order], begin, axis=0) + decay * w[keys]
        sw[keys] += g * g
        w[keys] -= 0.5 * g / np.sqrt(sw[keys])
        gb = p.sum(axis=0)
        sb += gb * gb
        b -= 0.1 * gb / np.sqrt(sb)
    return np.vstack([w, b])


def _some_texts(t: DataFrame, most: int, cond: Column) -> DataFrame:
    """Of the texts under ``cond`` the ``most`` distinct ones whose hashes are
    smallest; only hashes are ranked."""
    h = t.where(cond).select(F.xxhash64("_text").alias("h")).distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]
    if h is None:
        return t.limit(0)
    return t.where(F.xxhash64("_text") <= h).where(cond).groupBy(F.xxhash64("_text").alias("_h")).agg(F.min("_text").alias("_text")).select("_text")


def fit(docs: DataFrame, text: str = "text", max_rows: int = 3000, false_rate: float = 0.001, max_texts: int = 1000) -> Model:
    """Train on windows that the templates label, and on the templates.  Windows of
    a family are sought in all texts, unknown ones in at most ``max_texts`` distinct
    texts with a cue word and as many of all; each sort is bounded by ``max_rows``.
    The threshold leaves ``false_rate`` of held-back unknown windows above it."""
    spark = docs.sparkSession
    t = docs.select(F.col(text).alias("_text")).where("_text is not null")
    words = F.xxhash64(F.array_join("w", " "))

    def marked(d: DataFrame, cond: str, near: bool) -> DataFrame:
        """Windows of ``d`` under ``cond``: ``s``, the largest share of a template, and its family ``f``."""
        d = (_windows(d, "_text", near=near).withColumn("_tpl", F.expr(_templates())).withColumn("_any", F.expr(_every_gram())).select("_tpl", "_any", F.inline("_win"))
             .withColumn("_g", F.expr(_held_grams("w")))
             .withColumn("y", F.expr("if(arrays_overlap(_any, _g), array_max(transform(_tpl, t -> struct(size(array_intersect(t.g, _g)) / size(t.g) as s, -t.f as f))), "
                                     "struct(0D as s, 0 as f))"))
             .select("w", F.col("y.s").alias("s"), (-F.col("y.f")).alias("f")))
        return d.where(cond).select("w", "f").dropDuplicates(["w"]).orderBy(words, "w").limit(max_rows)

    near = marked(t, f"s >= {LABEL}", True)
    far = marked(_some_texts(t, max_texts, F.lower("_text").rlike(CUES)), f"s <= {NONE}", False).select("w", F.lit(0).alias("f"))
    plain = (_windows(_some_texts(t, max_texts, F.lit(True)), "_text", cue=False).select(F.inline("_win")).select("w", F.lit(0).alias("f")).dropDuplicates(["w"])
             .orderBy(words, "w").limit(max_rows))
    own = spark.createDataFrame([(x.split(), FAMILIES.index(f) + 1) for f, x in TEMPLATES], "w array<string>, f int")
    rows = near.unionByName(far).unionByName(plain).unionByName(own).select(F.expr(_features("w")).alias("x"), "f", F.pmod(words, F.lit(5)).alias("h")).collect()
    k = len(FAMILIES) + 1
    rows.sort(key=lambda r: (r.f, r.x))
    feats = [np.array(r.x, np.int64) for r in rows]
    y = np.array([r.f - 1 if r.f else k - 1 for r in rows])
    held = np.array([r.f == 0 and r.h == 0 for r in rows])
    w = _train([f for f, h in zip(feats, held) if not h], y[~held], k)
    top = [max(_probabilities(w, f)[:-1]) for f, h in zip(feats, held) if h]
    return Model(w, max(0.5, float(np.quantile(top, 1 - false_rate))) if top else 0.5)


def _probabilities(w: np.ndarray, f: np.ndarray) -> np.ndarray:
    z = w[f].sum(axis=0) / np.sqrt(len(f)) + w[-1]
    p = np.exp(z - z.max())
    return p / p.sum()


def scan(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``licenses``: per licence paragraph its number, the family, the
    probability and the share of the template, by paragraph; ``families``:
    the sorted distinct families.  Input columns of these two names give way;
    all others stay, whatever their names."""
    k = len(FAMILIES) + 1
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("licenses", "families")]
    d = _windows(docs.select(F.struct(*rest).alias("_row"), F.col(f"`{text}`").alias("_text")), "_text", near=True)
    # a prediction stands on a template's grams, so windows without any are not cut
    d = d.withColumn("_any", F.expr(_every_gram()))
    d = d.withColumn("_g", F.expr(f"filter(transform(_win, x -> struct(x.p as p, x.w as w, {_held_grams('x.w')} as g)), x -> arrays_overlap(_any, x.g))"))
    d = d.withColumn("_f", F.expr(f"transform(_g, x -> struct(x.p as p, {_features('x.w')} as f, x.g as g))"))
    z = ", ".join(f"aggregate(x.f, 0D, (s, b) -> s + element_at({_literal(model.weights[:-1, c])}, b + 1)) / sqrt(size(x.f)) + {model.weights[-1, c]:.6g}D" for c in range(k))
    d = d.withColumn("_z", F.expr(f"transform(_f, x -> struct(x.p as p, x.g as g, array({z}) as z))"))
    d = d.withColumn("_b", F.expr("transform(_z, x -> struct(x.p as p, x.g as g, int(array_position(x.z, array_max(x.z))) as k, 1 / aggregate(x.z, 0D, (s, y) -> s + exp(y - array_max(x.z))) as prob))"))
    d = d.withColumn("_tpl", F.expr(_templates()))
    d = d.withColumn("_hit", F.expr(f"filter(transform(filter(_b, x -> x.k < {k} and x.prob >= {model.threshold!r}D), x -> struct(x.p as p, x.k as k, x.prob as prob, {_held('t.f = x.k', 'x.g')} as held)), x -> x.held >= {CONFIRM}D)"))
    names = "array(" + ", ".join(f"'{f}'" for f in FAMILIES) + ")"
    # one entry per paragraph and family: the window with the largest share
    d = d.withColumn("_one", F.expr(f"""transform(array_sort(array_distinct(transform(_hit, x -> struct(x.p as p, x.k as k)))),
        u -> array_max(transform(filter(_hit, x -> x.p = u.p and x.k = u.k), x -> struct(x.held as held, x.prob as prob, u.p as p, u.k as k))))"""))
    found = F.expr(f"transform(_one, x -> named_struct('paragraph', x.p, 'family', element_at({names}, x.k), 'probability', x.prob, 'template_share', x.held))")
    d = d.withColumn("_found", found)
    return d.select("_row.*", F.inline(F.array(F.struct(F.col("_found").alias("licenses"),
                                                       F.array_sort(F.array_distinct(F.transform("_found", lambda x: x["family"]))).alias("families")))))


def columns() -> list[Column]:
    return [F.size("licenses").cast("bigint").alias("n_paragraphs"), F.array_join("families", ",").alias("families"),
            F.coalesce(F.array_max(F.transform("licenses", lambda x: x["probability"])), F.lit(0.0)).alias("probability")]
