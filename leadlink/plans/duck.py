"""SQL text of the same rules for the check engine, written from their definitions."""

from __future__ import annotations

from leadlink.functions.text import STOP_WORDS, WS


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def ascii_fold(x: str) -> str:
    return f"regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g')"


def pad(x: str, n: int) -> str:
    return f"(CASE WHEN length({x}) >= {n} THEN {x} ELSE lpad({x}, {n}, '0') END)"


def siret(x: str) -> str:
    s = strip(f"coalesce({x}, '')")
    num = f"CAST(CAST(trunc(CAST({s} AS DOUBLE)) AS HUGEINT) AS VARCHAR)"
    ok = f"regexp_full_match({s}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')"
    return f"(CASE WHEN {s} IN ('', 'nan', 'None') THEN '' WHEN {ok} THEN {pad(num, 14)} ELSE {s} END)"


def digits(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '\\P{{Nd}}', '', 'g')"


def cp(x: str) -> str:
    d = digits(x)
    return f"(CASE WHEN {d} = '' THEN '' ELSE {pad(d, 5)} END)"


def phone_valid(d: str) -> str:
    return f"(CASE WHEN regexp_full_match({d}, '0[1-9][0-9]{{8}}') THEN {d} ELSE '' END)"


def phone_nine(x: str) -> str:
    d = digits(x)
    z = f"(CASE WHEN {d} LIKE '33%' AND length({d}) >= 11 THEN '0' || substr({d}, 3) ELSE {d} END)"
    return f"(CASE WHEN {z} LIKE '0%' AND length({z}) = 10 THEN substr({z}, 2) ELSE '' END)"


def phone_signal(x: str) -> str:
    c = f"regexp_replace({strip(x)}, '({WS}|[.()-])+', '', 'g')"
    c = f"(CASE WHEN {c} LIKE '+33%' THEN '0' || substr({c}, 4) ELSE {c} END)"
    return phone_valid(digits(c))


def _drop(x: str, words: str, accents: bool = False) -> str:
    # RE2 has no look-around: tokenise on word characters and keep what is not a listed word
    parts = f"regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]+')"
    lst = ", ".join(f"'{w}'" for w in words.split())
    return f"array_to_string(list_filter({parts}, lambda w: w NOT IN ({lst})), '')"


def clean(x: str, words: str, accents: bool = False) -> str:
    up = f"replace(replace(upper({x}), 'ß', 'SS'), 'ẞ', 'SS')" if accents else f"upper({ascii_fold(x)})"
    return strip(f"regexp_replace({_drop(up, words)}, '{WS}+', ' ', 'g')")


def keywords(x: str) -> str:
    s = f"regexp_replace(regexp_replace(lower({ascii_fold(x)}), '[''-]', ' ', 'g'), '[^a-z0-9 ]', '', 'g')"
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS.split())
    return f"array_to_string(list_filter(string_split({s}, ' '), lambda w: length(w) > 1 AND w NOT IN ({stop})), ' ')"


def token_sort(x: str) -> str:
    return f"array_to_string(list_sort(list_filter(regexp_split_to_array({x}, '{WS}+'), lambda t: t <> '')), ' ')"


def title(x: str) -> str:
    runs = f"regexp_extract_all(lower({x}), '\\p{{L}}+|\\P{{L}}+')"
    return f"array_to_string(list_transform({runs}, lambda t: replace(replace(upper(t[1]), 'ß', 'Ss'), 'ẞ', 'Ss') || t[2:]), '')"


def naf(x: str) -> str:
    c = f"upper({strip(x)})"
    return (
        f"(CASE WHEN length({c}) >= 4 AND NOT contains({c}, '.') AND regexp_matches({c}, '^[0-9]{{2}}') "
        f"THEN substr({c}, 1, 2) || '.' || substr({c}, 3) ELSE {c} END)"
    )


def covered(code: str, expected: list[str]) -> str:
    """code is a normalised company code; expected codes are normalised and non-blank."""
    tests = []
    for e in expected:
        if len(e) >= 4 and e[-1].isdigit():
            tests.append(f"starts_with({code}, '{e}')")
        else:
            tests.append(f"{code} = '{e}'")
    return f"({code} <> '' AND ({' OR '.join(tests)}))"


def lcs(a: str, b: str) -> str:
    """Row-by-row table of the longest common subsequence."""
    codes_a = f"list_transform(string_split({a}, ''), lambda c: [unicode(c)])"
    codes_b = f"list_transform(string_split({b}, ''), lambda c: unicode(c))"
    zeros = f"list_transform(range(0, length({b}) + 1), lambda i: 0)"
    idx = f"list_transform(range(1, length({b}) + 1), lambda i: [CAST(i AS INTEGER)])"
    cell = (
        f"list_append(r, CASE WHEN ({codes_b})[j[1]] = x[1] THEN acc[j[1]] + 1 "
        f"ELSE greatest(r[len(r)], acc[j[1] + 1]) END)"
    )
    row = f"list_reduce(list_concat([[0]], {idx}), lambda r, j: {cell})"
    table = f"list_reduce(list_concat([{zeros}], {codes_a}), lambda acc, x: {row})"
    return f"(CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE ({table})[length({b}) + 1] END)"


def ratio(a: str, b: str) -> str:
    return (
        f"(CASE WHEN length({a}) + length({b}) = 0 THEN 100.0::DOUBLE "
        f"ELSE 200.0::DOUBLE * {lcs(a, b)} / (length({a}) + length({b})) END)"
    )


def pct_text(part: str, whole: str) -> str:
    """Half-to-even whole percentage as text."""
    x = f"(100.0::DOUBLE * {part} / {whole})"
    r = f"CAST(round_even({x}, 0) AS BIGINT)"
    return f"(CASE WHEN {whole} = 0 THEN '0%' ELSE {r} || '%' END)"


def filled(cols: list[str]) -> str:
    parts = [f"CASE WHEN {strip(f'CAST({c} AS VARCHAR)')} <> '' THEN 1 ELSE 0 END" for c in cols]
    return "(" + " + ".join(parts) + ")"
