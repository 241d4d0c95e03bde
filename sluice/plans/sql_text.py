"""SQL fragments that state the text steps for the comparison engine."""

from __future__ import annotations

from sluice.functions import stem
from sluice.functions.text import ENGLISH_STOP_WORDS, FUSED_WORDS
from sluice.plans.tables import DOMAIN_WORDS


def quoted(words) -> str:
    return ", ".join("'" + word.replace("'", "''") + "'" for word in words)


CLEAN = (
    "regexp_replace(regexp_replace(lower(text), '[^a-zA-Z\\s:]', '', 'g'), "
    f"'{'|'.join(DOMAIN_WORDS)}', '', 'g')"
)
SPLIT = (
    f"list_filter(regexp_split_to_array(regexp_replace({CLEAN}, '{FUSED_WORDS}', "
    "'\\1\\3\\5\\7 \\2\\4\\6\\8', 'g'), '\\W+'), lambda w: w <> '')"
)
TOKENS = f"list_filter({SPLIT}, lambda w: w not in ({quoted(ENGLISH_STOP_WORDS)}))"
SCORE = "floor(n_chars / len(regexp_split_to_array(text, '\\s+')))::bigint"

DOCS = (
    f"docs as (select doc_id, lang, source, {SCORE} as ltr, {TOKENS} as tokens "
    "from documents where text is not null)"
)
WORDS = "words as (select doc_id, unnest(tokens) as word from docs)"


def _case(table: dict[str, str]) -> str:
    return "case s " + " ".join(f"when '{k}' then '{v}'" for k, v in table.items()) + " end"


def stems(source: str, out: str = "stemmed") -> str:
    """Common table expressions that add ``stem`` to the ``word`` column of ``source``."""
    v = stem.VOWELS
    ends = "({})$"

    def find(name: str, previous: str, pattern: str) -> str:
        return (
            f"{name} as (select *, left(w, (length(w) - length(s))::bigint) as b, "
            "s <> '' and length(w) - length(s) >= p1 as r1, "
            "s <> '' and length(w) - length(s) >= p2 as r2 "
            f"from (select * exclude (s, b, r1, r2), regexp_extract(w, '{pattern}', 1) as s "
            f"from {previous}))"
        )

    def change(name: str, previous: str, value: str) -> str:
        return f"{name} as (select * replace (({value}) as w) from {previous})"

    irregular = " ".join(f"when '{k}' then '{x}'" for k, x in stem.IRREGULAR.items())
    return ",\n".join(
        [
            f"t0 as (select *, '' as s, '' as b, false as r1, false as r2, false as cut, "
            f"regexp_replace(regexp_replace(word, '^y', 'Y'), '([{v}])y', '\\1Y', 'g') as w "
            f"from {source})",
            f"t1 as (select *, case when regexp_matches(w, '{stem.FIXED_REGION}') "
            f"then length(regexp_extract(w, '{stem.FIXED_REGION}')) "
            f"when length(regexp_extract(w, '{stem.FIRST_REGION}')) > 0 "
            f"then length(regexp_extract(w, '{stem.FIRST_REGION}')) else length(w) end as p1 "
            "from t0)",
            "t2 as (select *, case when x > 0 then p1 + x else length(w) end as p2 from "
            f"(select *, length(regexp_extract(substr(w, p1 + 1), '{stem.FIRST_REGION}')) as x "
            "from t1))",
            find("t3", "t2", ends.format("sses|ied|ies|us|ss|s")),
            change(
                "t4",
                "t3",
                "case when s = 'sses' then b || 'ss' "
                "when s in ('ied', 'ies') then b || case when length(w) > 4 then 'i' else 'ie' end "
                f"when s = 's' and regexp_matches(w, '[{v}].+s$') then b else w end",
            ),
            find("t5", "t4", ends.format("eedly|ingly|edly|eed|ing|ed")),
            f"t6 as (select * replace ((s not in ('', 'eed', 'eedly') "
            f"and regexp_matches(b, '[{v}]')) as cut) from t5)",
            change(
                "t7",
                "t6",
                "case when s in ('eed', 'eedly') and r1 then b || 'ee' when cut then b else w end",
            ),
            change(
                "t8",
                "t7",
                "case when not cut then w when regexp_matches(w, '(at|bl|iz)$') then w || 'e' "
                f"when regexp_matches(w, '{stem.DOUBLE_END}') then left(w, length(w) - 1) "
                f"when length(w) <= p1 and regexp_matches(w, '{stem.SHORT_WORD}') then w || 'e' "
                "else w end",
            ),
            change("t9", "t8", f"regexp_replace(w, '^(.+[^{v}])[yY]$', '\\1i')"),
            find("t10", "t9", ends.format("|".join(stem.STEP_2))),
            change(
                "t11",
                "t10",
                "case when r1 and (s <> 'li' or regexp_matches(b, '[cdeghkmnrt]$')) "
                f"and (s <> 'ogi' or b like '%l') then b || {_case(stem.STEP_2)} else w end",
            ),
            find("t12", "t11", ends.format("|".join(stem.STEP_3))),
            change(
                "t13",
                "t12",
                f"case when r1 and (s <> 'ative' or r2) then b || {_case(stem.STEP_3)} "
                "else w end",
            ),
            find("t14", "t13", ends.format("|".join(stem.STEP_4))),
            change(
                "t15",
                "t14",
                "case when r2 and (s <> 'ion' or regexp_matches(b, '[st]$')) then b else w end",
            ),
            find("t16", "t15", "(e|l)$"),
            change(
                "t17",
                "t16",
                "case when s = 'l' and r2 and b like '%l' then b when s = 'e' and r2 then b "
                "when s = 'e' and r1 and length(w) >= 4 "
                f"and not regexp_matches(w, '{stem.SHORT_SYLLABLE_E}') then b else w end",
            ),
            f"{out} as (select * exclude (s, b, r1, r2, cut, w, p1, p2, x), "
            f"case when length(word) <= 2 then word else case word {irregular} "
            "else replace(w, 'Y', 'y') end end as stem from t17)",
        ]
    )


VOCAB = (
    "counts as (select word, count(*) as n from words group by word),\n"
    + stems("counts")
    + ",\nvocab as (select word as orig, stem, n from stemmed)"
)
REPRESENTATIVES = (
    "best as (select stem, orig, n from vocab "
    "qualify row_number() over (partition by stem order by n desc, orig) = 1)"
)
RESTORED_DOCS = (
    "restored as (select d.doc_id, d.ltr, "
    "coalesce(list(b.orig order by w.pos) filter (where w.word is not null), []) as tokens "
    "from docs d left join (select doc_id, unnest(tokens) as word, "
    "generate_subscripts(tokens, 1) as pos from docs) w on w.doc_id = d.doc_id "
    "left join vocab v on v.orig = w.word left join best b on b.stem = v.stem "
    "group by d.doc_id, d.ltr)"
)


def grams(source: str, n_max: int) -> str:
    """``grams``: one row per n-gram of the words of two letters or more."""
    runs = " union all ".join(
        f"select doc_id, unnest(list_transform(generate_series(1, len(t) - {n - 1}), "
        f"lambda i: array_to_string(t[i:i + {n - 1}], ' '))) as term from long_words"
        for n in range(1, n_max + 1)
    )
    return (
        "long_words as (select doc_id, list_filter(tokens, lambda w: length(w) >= 2) as t "
        f"from {source}),\ngrams as ({runs})"
    )


def tfidf(source: str, n_max: int, max_features: int) -> str:
    """``kept`` (the vocabulary) and ``weights`` over the documents of ``source``."""
    return (
        f"{grams(source, n_max)},\n"
        "tf as (select doc_id, term, count(*) as tf from grams group by all),\n"
        "stats as (select term, count(*) as df, sum(tf)::bigint as cf from tf group by term),\n"
        f"total as (select count(*) as n from {source}),\n"
        "kept as (select term, df, cf from stats, total where df >= 0.001 * n and df <= 0.7 * n "
        f"order by cf desc, term limit {max_features}),\n"
        "raw as (select doc_id, term, tf * (ln((1.0 + n) / (1 + df)) + 1) as w "
        "from tf join kept using (term), total),\n"
        "weights as (select doc_id, term, w / sqrt(sum(w * w) over (partition by doc_id)) as weight "
        "from raw)"
    )
