"""Ordered regex classification, label splitting and quality flags."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# --- fixed values: ordered rules, first hit wins ------------------------------------------
ARTEFACT, NON_RESPONSE, CANDIDATE = "Artefato", "Não-resposta", "Candidato"
ANSWER_RULES = (
    (ARTEFACT, r"^(header|column)[ 0-9]*$"),
    (ARTEFACT, r"vantagem|diferen|lead|margem|amostra"),
    (NON_RESPONSE, r"indecis|absten|absent|outros|branco|nulo|nenhum|nao sabe|não sabe"),
)
METHOD_RULES = (
    ("Telefônica automatizada (URA)", r"\bura\b|\bivr\b|automatizad|resposta aud"),
    ("Telefônica com entrevistador", r"\bcati\b|telef"),
    ("Web / painel online", r"\bweb\b|online|on-line|internet|whatsapp|\bsms\b|link"),
    (
        "Presencial",
        r"pessoa|domicil|residenc|residência|face a face|face-a-face|presencia|pontos? de fluxo"
        r"|porta a porta|in loco",
    ),
)
UNCLASSIFIED_METHOD = "Não classificada"
CONTRACT_LABELS = (("S", "Própria"), ("N", "Contratada"))
UNAFFILIATED = "Sem partido"
UNAFFILIATED_PATTERN = r"(?i) sem partido$"
MARKUP_LEFTOVER_PATTERN = r"<|\[|ref name="
# ----------------------------------------------------------------------------------------


def classify(col: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first rule whose pattern occurs in the lower-case text."""
    text = F.lower(col)
    label = F.when(text.rlike(rules[0][1]), rules[0][0])
    for name, pattern in rules[1:]:
        label = label.when(text.rlike(pattern), name)
    return label.otherwise(default)


def classify_answer(col: Column) -> Column:
    return classify(col, ANSWER_RULES, CANDIDATE)


def classify_method(col: Column) -> Column:
    return classify(col, METHOD_RULES, UNCLASSIFIED_METHOD)


def code_label(col: Column, labels: Sequence[tuple[str, str]] = CONTRACT_LABELS) -> Column:
    """Code to label; an unknown code is NULL."""
    label = F.when(col == labels[0][0], labels[0][1])
    for code, text in labels[1:]:
        label = label.when(col == code, text)
    return label


def split_trailing_token(label: Column) -> tuple[Column, Column]:
    """``"Jane Doe ABC"`` as (``"Jane Doe"``, ``"ABC"``); one word has no token."""
    unaffiliated = label.rlike(UNAFFILIATED_PATTERN)
    several_words = label.contains(" ")
    name = (
        F.when(unaffiliated, F.regexp_replace(label, UNAFFILIATED_PATTERN, ""))
        .when(several_words, F.regexp_replace(label, " [^ ]+$", ""))
        .otherwise(label)
    )
    token = F.when(unaffiliated, F.lit(UNAFFILIATED)).when(
        several_words, F.regexp_extract(label, " ([^ ]+)$", 1)
    )
    return name, token


def quality_flags(
    sample: Column,
    amount: Column,
    start: Column,
    end: Column,
    published: Column,
    registered: Column,
    trade_name: Column,
    notice_days: int,
) -> dict[str, Column]:
    """Six flags that mark a row without removing it; unknown inputs stay unknown."""
    return {
        "fl_dq_amostra_invalida": sample.isNull(),
        "fl_dq_valor_ausente": amount.isNull() | (amount == 0),
        "fl_dq_campo_invertido": start > end,
        "fl_dq_divulgacao_antes_fim_campo": published < end,
        "fl_dq_registro_fora_prazo_legal": F.datediff(published, registered) < notice_days,
        "fl_dq_sem_nome_fantasia": trade_name.isNull(),
    }


def any_alert(*flags: Column) -> Column:
    """Three-valued OR."""
    return reduce(or_, flags)


def blank_or_marked_up(name: Column) -> Column:
    """A display name that is empty or still carries markup."""
    return (F.trim(F.coalesce(name, F.lit(""))) == "") | name.rlike(MARKUP_LEFTOVER_PATTERN)
