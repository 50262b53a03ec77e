"""The Porter stemmer (extended mode) as one DuckDB SQL expression.

Used only by the correctness oracle, so that the stemmed index can be checked
against SQL: the rules are the same fixed tables, applied by the SQL engine. It is written
differently on purpose: the consonant/vowel form of a stem is built with
``list_reduce`` over its characters and every step is a ``CASE`` over suffix
tests; intermediate values are bound once with
``list_transform([x], lambda v: ...)[1]``.
"""

from __future__ import annotations

import itertools

from quarry.functions.porter import IRREGULAR_FORMS, STEP2_RULES, STEP3_RULES, STEP4_SUFFIXES

_ids = itertools.count()


def _bind(expr: str, body) -> str:
    v = f"v{next(_ids)}"
    return f"list_transform([{expr}], lambda {v}: {body(v)})[1]"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _cut(w: str, k: int) -> str:
    return f"left({w}, length({w}) - {k})"


def _cv(s: str) -> str:
    return (
        f"(CASE WHEN {s} = '' THEN '' ELSE list_reduce(list_prepend('', string_split({s}, '')), "
        "lambda acc, ch: acc || CASE WHEN ch IN ('a','e','i','o','u') THEN 'v' "
        "WHEN ch = 'y' THEN (CASE WHEN right(acc, 1) = 'c' THEN 'v' ELSE 'c' END) ELSE 'c' END) END)"
    )


def _mc(c: str) -> str:
    """Porter's m from a consonant/vowel string."""
    return f"((length({c}) - length(replace({c}, 'vc', ''))) // 2)"


def _cvc_c(s: str, c: str) -> str:
    return (
        f"((length({s}) >= 3 AND right({c}, 3) = 'cvc' AND right({s}, 1) NOT IN ('w','x','y')) "
        f"OR (length({s}) = 2 AND {c} = 'vc'))"
    )


def _with_cv(word: str, body) -> str:
    """Bind a word and its consonant/vowel string once; the cv form of a
    prefix is the prefix of the cv form, so steps slice it instead of
    recomputing it."""
    return _bind(word, lambda w: _bind(_cv(w), lambda c: body(w, c)))


def _step1a(w: str, c: str) -> str:
    return (
        f"(CASE WHEN length({w}) = 4 AND suffix({w}, 'ies') THEN left({w}, 1) || 'ie' "
        f"WHEN suffix({w}, 'sses') THEN {_cut(w, 2)} "
        f"WHEN suffix({w}, 'ies') THEN {_cut(w, 2)} "
        f"WHEN suffix({w}, 'ss') THEN {w} "
        f"WHEN suffix({w}, 's') THEN {_cut(w, 1)} ELSE {w} END)"
    )


def _after_ed_ing(s: str, c: str) -> str:
    double = f"(length({s}) >= 2 AND right({s}, 1) = substr({s}, length({s}) - 1, 1) AND right({c}, 1) = 'c')"
    return (
        f"(CASE WHEN suffix({s}, 'at') OR suffix({s}, 'bl') OR suffix({s}, 'iz') THEN {s} || 'e' "
        f"WHEN {double} THEN (CASE WHEN right({s}, 1) IN ('l','s','z') THEN {s} ELSE {_cut(s, 1)} END) "
        f"WHEN {_mc(c)} = 1 AND {_cvc_c(s, c)} THEN {s} || 'e' ELSE {s} END)"
    )


def _step1b(w: str, c: str) -> str:
    def sub(k: int) -> str:
        return _bind(_cut(w, k), lambda s: _bind(_cut(c, k), lambda cc: _after_ed_ing(s, cc)))

    return (
        f"(CASE WHEN suffix({w}, 'ied') THEN {_cut(w, 3)} || (CASE WHEN length({w}) = 4 THEN 'ie' ELSE 'i' END) "
        f"WHEN suffix({w}, 'eed') THEN (CASE WHEN {_mc(_cut(c, 3))} > 0 THEN {_cut(w, 1)} ELSE {w} END) "
        f"WHEN suffix({w}, 'ed') AND contains({_cut(c, 2)}, 'v') THEN {sub(2)} "
        f"WHEN suffix({w}, 'ing') AND contains({_cut(c, 3)}, 'v') THEN {sub(3)} "
        f"ELSE {w} END)"
    )


def _step1c(w: str, c: str) -> str:
    return (
        f"(CASE WHEN suffix({w}, 'y') AND length({w}) > 2 AND right({_cut(c, 1)}, 1) = 'c' "
        f"THEN {_cut(w, 1)} || 'i' ELSE {w} END)"
    )


def _rules(w: str, c: str, rules, cond) -> str:
    parts = []
    for suffix, repl in rules:
        stem = _cut(w, len(suffix))
        parts.append(
            f"WHEN suffix({w}, {_q(suffix)}) THEN (CASE WHEN {cond(w, c, suffix)} "
            f"THEN {stem} || {_q(repl)} ELSE {w} END)"
        )
    return f"(CASE {' '.join(parts)} ELSE {w} END)"


def _step2_rules(w: str, c: str) -> str:
    def cond(word, cv, suffix):
        keep = 3 if suffix == "logi" else len(suffix)
        return f"{_mc(_cut(cv, keep))} > 0"

    return _rules(w, c, STEP2_RULES, cond)


def _step2(w: str, c: str) -> str:
    return (
        f"(CASE WHEN suffix({w}, 'alli') AND {_mc(_cut(c, 4))} > 0 "
        f"THEN {_with_cv(_cut(w, 4) + ' || ' + _q('al'), _step2_rules)} ELSE {_step2_rules(w, c)} END)"
    )


def _step3(w: str, c: str) -> str:
    return _rules(w, c, STEP3_RULES, lambda word, cv, suffix: f"{_mc(_cut(cv, len(suffix)))} > 0")


def _step4(w: str, c: str) -> str:
    def cond(word, cv, suffix):
        base = f"{_mc(_cut(cv, len(suffix)))} > 1"
        if suffix == "ion":
            return f"({base} AND right({_cut(word, 3)}, 1) IN ('s','t'))"
        return base

    return _rules(w, c, [(s, "") for s in STEP4_SUFFIXES], cond)


def _step5a(w: str, c: str) -> str:
    s, cs = _cut(w, 1), _cut(c, 1)
    return (
        f"(CASE WHEN suffix({w}, 'e') AND ({_mc(cs)} > 1 OR ({_mc(cs)} = 1 AND NOT {_cvc_c(s, cs)})) "
        f"THEN {s} ELSE {w} END)"
    )


def _step5b(w: str, c: str) -> str:
    return f"(CASE WHEN suffix({w}, 'll') AND {_mc(_cut(c, 1))} > 1 THEN {_cut(w, 1)} ELSE {w} END)"


def porter_sql(word_expr: str) -> str:
    """SQL expression: the stem of the lower-case word ``word_expr``."""
    expr = word_expr
    for step in (_step1a, _step1b, _step1c, _step2, _step3, _step4, _step5a, _step5b):
        expr = _with_cv(expr, step)
    irregular = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in IRREGULAR_FORMS.items())
    return (
        f"(CASE {word_expr} {irregular} ELSE "
        f"(CASE WHEN length({word_expr}) <= 2 THEN {word_expr} ELSE {expr} END) END)"
    )
