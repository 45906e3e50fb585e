"""Deterministic stand-ins for the caller-supplied judge and model functions."""

from __future__ import annotations

import json

import pandas as pd


def points(texts: pd.Series) -> list[str]:
    """Deterministic stand-in judge: each distinct word is a point, weight = word length."""
    out = []
    for t in texts:
        points = [{"info_point": w, "importance_score": len(w)} for w in dict.fromkeys(t.split(" "))]
        out.append("```json\n" + json.dumps(points) + "\n```")
    return out


def match(pairs: pd.Series) -> list[str]:
    """Deterministic stand-in judge: equal words match."""
    out = []
    for p in pairs:
        both = json.loads(p)
        g = {x["info_point"]: x for x in both["gt_wips"]}
        m = {x["info_point"]: x for x in both["model_wips"]}
        out.append(json.dumps({
            "matches": [{"gt_wip": g[w], "model_wip": m[w]} for w in g if w in m],
            "unmatched_model_wips": [x for w, x in m.items() if w not in g],
            "unmatched_gt_wips": [x for w, x in g.items() if w not in m]}))
    return out


def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return (a.str.len() % 5).astype("float64") / 5


def verdict(pairs: pd.Series) -> list[str]:
    """Deterministic stand-in judge: score from the length of the model text."""
    return [json.dumps({"llm_score": len(json.loads(p)["model"]) % 7, "llm_reason": "length"}) for p in pairs]


def echo(texts: pd.Series) -> list[str]:
    """Deterministic stand-in model that refuses short prompts."""
    if (texts.str.len() < 40).any():
        raise ValueError("prompt too short")
    return list(texts.str.len().astype(str))
