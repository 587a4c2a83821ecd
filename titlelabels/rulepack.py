"""The weighted phrase rules, kept as data, and the compiler from phrase to pattern.

A phrase is plain upper-case text in which

``~``      any amount of white space, none included
``=``      exactly one white space character or hyphen (``=?`` makes it optional)
``#``      one digit
``[x]``    optional text
``{a|b}``  either text

and everything else, a single blank included, stands for itself. A phrase is
always bounded by word boundaries at both ends.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from titlelabels.taxonomy import LABELS, ROLE

@dataclass(frozen=True)
class Rule:
    rule_id: int
    tag: str
    phrases: tuple[str, ...]
    roles: tuple[str, ...]
    note_types: tuple[str, ...]
    weight: float
    veto: str | None = None

    def labels(self, dim: str) -> tuple[str, ...]:
        return self.roles if dim == ROLE else self.note_types


@dataclass(frozen=True)
class Dialect:
    """How the marks of a phrase are spelled in one regex engine."""

    space: str
    space_or_hyphen: str
    digit: str
    start: str
    end_after_word: str
    end_after_other: str
    veto: str | None  # None: the engine has no look-ahead


# The titles are folded first (functions.text.fold_title), so no case flag is
# needed; the classes below are Unicode white space, digits and word characters.
_WORD = r"[\p{L}\p{N}_]"
JAVA = Dialect(
    space=r"[\t-\r\x1c-\x20\x85\p{Z}]",
    space_or_hyphen=r"[\t-\r\x1c-\x20\x85\p{Z}-]",
    digit=r"\p{Nd}",
    start=f"(?<!{_WORD})",
    end_after_word=f"(?!{_WORD})",
    end_after_other=f"(?={_WORD})",
    veto=r"(?![^\n]*%s)",
)
# Linear-time engines (RE2) for ASCII titles; the caller handles the veto.
RE2 = Dialect(
    space=r"\s",
    space_or_hyphen=r"[\s-]",
    digit=r"\d",
    start=r"\b",
    end_after_word=r"\b",
    end_after_other=r"\b",
    veto=None,
)

_MARKS = {"[": "(?:", "]": ")?", "{": "(?:", "|": "|", "}": ")", "?": "?"}


def phrase_pattern(phrase: str, dialect: Dialect) -> str:
    """Body of one phrase, boundaries not included."""
    marks = _MARKS | {"~": dialect.space + "*", "=": dialect.space_or_hyphen, "#": dialect.digit}
    return "".join(marks.get(ch) or (ch if ch.isalnum() or ch in " _" else "\\" + ch) for ch in phrase)


def rule_pattern(rule: Rule, dialect: Dialect = JAVA) -> str:
    """One search pattern for all phrases of a rule."""
    after_word = [p for p in rule.phrases if p[-1].isalnum() or p[-1] in "#]}"]
    after_other = [p for p in rule.phrases if p not in after_word]
    ends = []
    for phrases, end in ((after_word, dialect.end_after_word), (after_other, dialect.end_after_other)):
        if phrases:
            ends.append("(?:" + "|".join(phrase_pattern(p, dialect) for p in phrases) + ")" + end)
    body = dialect.start + "(?:" + "|".join(ends) + ")"
    if rule.veto and dialect.veto:
        body += dialect.veto % re.escape(rule.veto)
    return body


def any_pattern(rules: tuple[Rule, ...], dialect: Dialect = JAVA) -> str:
    """Pattern that is found whenever one of the rules is (vetoes aside).

    The phrases are grouped by first letter, so that a position of the title is
    left after a few comparisons.
    """
    by_letter: dict[str, list[str]] = {}
    others = []
    for phrase in (p for r in rules for p in r.phrases):
        end = dialect.end_after_word if phrase[-1].isalnum() or phrase[-1] in "#]}" else dialect.end_after_other
        body = phrase_pattern(phrase, dialect) + end
        if phrase[0].isalpha() and phrase[1:2] != "?":
            by_letter.setdefault(phrase[0], []).append(body[1:])
        else:
            others.append(body)
    branches = [letter + "(?:" + "|".join(rest) + ")" for letter, rest in by_letter.items()]
    return dialect.start + "(?:" + "|".join(branches + others) + ")"


def _well_formed(phrase: str) -> bool:
    """Brackets and braces are closed one by one, bars stand in braces, and no optional end follows a dot."""
    inside = ""
    for before, ch in zip(" " + phrase, phrase, strict=False):
        if ch in "[{":
            if inside or (ch == "[" and before == "."):
                return False
            inside = ch
        elif ch in "]}":
            if inside != {"]": "[", "}": "{"}[ch]:
                return False
            inside = ""
        elif ch == "|" and inside != "{":
            return False
    return not inside


def check_rules(rules: tuple[Rule, ...]) -> tuple[Rule, ...]:
    """Raise on packs the scoring cannot honour."""
    if len({r.tag for r in rules}) != len(rules) or len({r.rule_id for r in rules}) != len(rules):
        raise ValueError("rule ids and tags must be unique")
    for r in rules:
        if not r.weight > 0:
            raise ValueError(f"rule {r.tag}: the weight must be positive")
        if not r.phrases or not all(p and (p[0].isalnum() or p[0] in "{") for p in r.phrases):
            raise ValueError(f"rule {r.tag}: phrases must start with a letter or digit")
        if not all(_well_formed(p) for p in r.phrases):
            raise ValueError(f"rule {r.tag}: marks must be closed, and bars stand in braces")
        if any(p != p.upper() for p in r.phrases):
            raise ValueError(f"rule {r.tag}: phrases are written in upper case")
    return tuple(sorted(rules, key=lambda r: r.rule_id))


# Rule id, tag, phrases, roles, note types, weight. The row order is the audit
# order and the order in which weights add up. A rule with a veto does not fire on an
# occurrence that the veto's letters follow on the same line.
RULES = check_rules((
    Rule(1, "clinical:title_physician", ("PHYSICIAN", "ATTENDING", "RESIDENT", "FELLOW", "INTERN"), ("CLINICAL",), (), 0.80),
    Rule(2, "clinical:credential_suffix", ("MD", "DO", "NP", "PA", "ARNP", "CRNA"), ("CLINICAL",), (), 0.75),
    Rule(3, "clinical:medicine_service", ("MEDICINE",), ("CLINICAL",), (), 0.55, veto="MEDICATION"),
    Rule(4, "clinical:surgery", ("SURGERY", "SURGICAL", "OPERATIVE", "ANESTHESIA", "ANESTHESIOLOGY"), ("CLINICAL",), (), 0.75),
    Rule(5, "clinical:psychiatry", ("PSYCHIATRY", "PSYCHIATRIC", "PSYCH"), ("CLINICAL",), (), 0.65),
    Rule(6, "clinical:specialty_service", ("CARDIOLOGY", "PULMONOLOGY", "NEPHROLOGY", "NEUROLOGY", "ONCOLOGY", "HEMATOLOGY", "GASTROENTEROLOGY", "GI", "ENDOCRINOLOGY", "RHEUMATOLOGY", "DERMATOLOGY", "UROLOGY", "ORTHOPEDIC", "ORTHOPAEDIC", "OPHTHALMOLOGY", "OTOLARYNGOLOGY", "ENT", "VASCULAR", "THORACIC", "TRAUMA"), ("CLINICAL",), (), 0.80),
    Rule(7, "clinical:palliative", ("PALLIATIVE", "HOSPICE", "PAIN MANAGEMENT", "PAIN CLINIC"), ("CLINICAL",), (), 0.70),
    Rule(8, "clinical:icu_unit", ("ICU", "CCU", "MICU", "SICU", "NICU", "PICU"), ("CLINICAL",), ("PROGRESS",), 0.60),
    Rule(9, "clinical:hp", ("HISTORY~{AND|&}~PHYSICAL", "H~&~P", "H/P"), ("CLINICAL",), ("ADMISSION",), 0.90),
    Rule(10, "nursing:keyword_nursing", ("NURSING",), ("NURSING",), (), 0.90),
    Rule(11, "nursing:credential", ("RN", "LPN", "CNA", "LVN"), ("NURSING",), (), 0.80),
    Rule(12, "nursing:keyword_nurse", ("NURSE", "NURSES"), ("NURSING",), (), 0.85),
    Rule(13, "nursing:flowsheet", ("FLOW~SHEET", "MAR", "MEDICATION~ADMINISTRATION"), ("NURSING",), ("PROGRESS",), 0.70),
    Rule(14, "nursing:shift_note", ("SHIFT~{NOTE|SUMMARY|REPORT}", "END~OF~SHIFT"), ("NURSING",), ("HANDOFF",), 0.85),
    Rule(15, "nursing:fall_risk", ("FALL~RISK", "FALL~PREVENTION", "BRADEN", "MORSE"), ("NURSING",), ("ASSESSMENT",), 0.75),
    Rule(16, "nursing:wound", ("WOUND~CARE", "WOUND~ASSESSMENT", "OSTOMY", "SKIN~CARE", "PRESSURE~{ULCER|INJURY|WOUND}"), ("NURSING",), ("ASSESSMENT",), 0.70),
    Rule(17, "nursing:iv_access", ("{IV|INTRAVENOUS}~{ACCESS|LINE|CARE|NOTE|ASSESSMENT}",), ("NURSING",), ("PROCEDURE",), 0.72),
    Rule(18, "sw:keyword_sw", ("SOCIAL~WORK[ER]", "MSW", "LCSW", "LMSW"), ("SOCIAL_WORK",), (), 0.90),
    Rule(19, "sw:case_manager", ("{CASE|CARE}~MANAG{ER|EMENT}",), ("SOCIAL_WORK",), (), 0.85),
    Rule(20, "sw:dc_planning", ("{DISCHARGE|DC}~PLAN[NING]",), ("SOCIAL_WORK",), ("DISCHARGE", "PLAN"), 0.75),
    Rule(21, "sw:housing", ("HOMELESSNESS", "HOUSING~INSTAB", "HOUSING~ASSESS"), ("SOCIAL_WORK",), ("ASSESSMENT",), 0.80),
    Rule(22, "sw:psychosocial", ("PSYCHOSOCIAL", "SOCIAL~HISTORY", "SOCIAL~ASSESSMENT"), ("SOCIAL_WORK",), ("ASSESSMENT",), 0.78),
    Rule(23, "sw:advance_directive", ("ADVANCE~DIRECTIVE", "POWER~OF~ATTORNEY", "HEALTHCARE~PROXY", "SURROGATE", "GUARDIAN"), ("SOCIAL_WORK", "ADMINISTRATIVE"), ("ADMINISTRATIVE",), 0.70),
    Rule(24, "sw:substance", ("SUBSTANCE~ABUSE", "ALCOHOL", "ADDICTION", "SATP", "BSAS", "DAST", "AUDIT"), ("SOCIAL_WORK",), ("ASSESSMENT",), 0.65),
    Rule(25, "allied:pt", ("PHYSICAL~THERAP{Y|IST}", "PT~EVAL", "PT~NOTE", "P.T."), ("ALLIED_HEALTH",), (), 0.90),
    Rule(26, "allied:ot", ("OCCUPATIONAL~THERAP{Y|IST}", "OT~EVAL", "OT~NOTE", "O.T."), ("ALLIED_HEALTH",), (), 0.90),
    Rule(27, "allied:rt", ("RESPIRATORY~THERAP{Y|IST}", "RT~NOTE", "RESP~CARE", "VENTILATOR~NOTE", "VENT~MANAGEMENT"), ("ALLIED_HEALTH",), (), 0.88),
    Rule(28, "allied:nutrition", ("NUTRITION", "DIETITIAN", "DIETETICS", "DIETARY", "RD~NOTE", "NUTRITIONAL~ASSESS"), ("ALLIED_HEALTH",), (), 0.88),
    Rule(29, "allied:pharmacy", ("PHARMAC{Y|IST}", "PHARM~NOTE", "MEDICATION~RECONCIL", "MED~REC", "CLINICAL~PHARM"), ("ALLIED_HEALTH",), (), 0.85),
    Rule(30, "allied:slp", ("SPEECH", "LANGUAGE~PATH", "SLP", "DYSPHAGIA", "SWALLOW[ING]"), ("ALLIED_HEALTH",), (), 0.88),
    Rule(31, "allied:audiology", ("AUDIOLOGY", "AUDIOLOGIST", "HEARING~{TEST|EVAL|ASSESS}"), ("ALLIED_HEALTH",), (), 0.88),
    Rule(32, "allied:chaplain", ("CHAPLAIN", "SPIRITUAL~CARE", "PASTORAL~CARE"), ("ALLIED_HEALTH",), ("ASSESSMENT",), 0.85),
    Rule(33, "allied:kinesiotherapy", ("KINESIOTHERAPY", "KINESIO", "RECREATION~THERAP", "RECREATIONAL~THERAP"), ("ALLIED_HEALTH",), (), 0.88),
    Rule(34, "admin:him", ("HIM", "HEALTH~INFORMATION", "MEDICAL~RECORD[S]", "MRT"), ("ADMINISTRATIVE",), (), 0.85),
    Rule(35, "admin:transcription", ("TRANSCRIPTION", "TRANSCRIBED", "DICTATED~BY"), ("ADMINISTRATIVE",), (), 0.75),
    Rule(36, "admin:consent", ("CONSENT~FORM", "INFORMED~CONSENT"), ("ADMINISTRATIVE",), ("ADMINISTRATIVE",), 0.80),
    Rule(37, "admin:coding", ("CODING", "ICD", "CPT", "DRG", "BILLING"), ("ADMINISTRATIVE",), ("ADMINISTRATIVE",), 0.85),
    Rule(38, "type:admission", ("ADMISSION", "ADMIT", "ADMITTING", "INTAKE"), (), ("ADMISSION",), 0.85),
    Rule(39, "type:hp", ("HISTORY~{AND|&}~PHYSICAL", "H~&~P"), (), ("ADMISSION",), 0.90),
    Rule(40, "type:initial_eval", ("INITIAL~{EVAL|ASSESSMENT|NOTE|CONSULT}",), (), ("ADMISSION",), 0.70),
    Rule(41, "type:progress", ("PROGRESS~NOTE", "PN", "DAILY~NOTE", "INTERVAL~NOTE", "DAILY~PROGRESS"), (), ("PROGRESS",), 0.90),
    Rule(42, "type:soap", ("SOAP",), (), ("PROGRESS",), 0.85),
    Rule(43, "type:assessment", ("ASSESSMENT", "EVAL[UATION]", "SCREEN[ING]"), (), ("ASSESSMENT",), 0.70),
    Rule(44, "type:standardized_screen", ("PHQ[S]=?#", "GAD=?#", "MMSE", "MOCA", "CAGE", "AUDIT", "CIWA", "CPRS~SCREEN", "MINI=?MENTAL"), (), ("ASSESSMENT",), 0.90),
    Rule(45, "type:risk_assessment", ("RISK~ASSESS", "SAFETY~ASSESS", "SUICIDE~RISK", "VIOLENCE~RISK"), (), ("ASSESSMENT",), 0.88),
    Rule(46, "type:care_plan", ("CARE~PLAN", "TREATMENT~PLAN", "PLAN~OF~CARE", "INTERDISCIPLINARY~PLAN", "IDT~PLAN"), (), ("PLAN",), 0.90),
    Rule(47, "type:procedure", ("PROCEDURE", "PROCEDURAL", "OPERATIVE", "OPERATION", "OP~NOTE", "OPERATIVE~REPORT"), (), ("PROCEDURE",), 0.88),
    Rule(48, "type:named_procedure", ("BRONCHOSCOPY", "ENDOSCOPY", "COLONOSCOPY", "BIOPSY", "PARACENTESIS", "THORACENTESIS", "LUMBAR~PUNCTURE", "LP", "INTUBATION", "LINE~PLACE", "CENTRAL~LINE", "ARTERIAL~LINE", "CATHETER[IZATION]"), (), ("PROCEDURE",), 0.90),
    Rule(49, "type:consult", ("CONSULT[ATION]",), (), ("CONSULT",), 0.90),
    Rule(50, "type:referral", ("REQUEST~FOR~CONSULT", "REFERRAL"), (), ("CONSULT",), 0.80),
    Rule(51, "type:handoff", ("HANDOFF", "HAND=OFF", "SIGN=OUT", "SIGNOUT", "SBAR", "TRANSFER~NOTE", "TRANSFER~SUMMARY"), (), ("HANDOFF",), 0.90),
    Rule(52, "type:shift", ("SHIFT~{NOTE|REPORT|SUMMARY}", "END=OF=SHIFT"), (), ("HANDOFF",), 0.88),
    Rule(53, "type:discharge", ("DISCHARGE~{SUMMARY|SUMM|NOTE|INSTRUCTION|PLANNING|PLAN|DISPOSITION}", "DC~SUMM[ARY]"), (), ("DISCHARGE",), 0.92),
    Rule(54, "type:avs", ("AFTER~VISIT~SUMMARY", "AVS"), (), ("DISCHARGE", "EDUCATION"), 0.85),
    Rule(55, "type:addendum", ("ADDENDUM", "ADDENDA", "AMENDMENT", "AMENDED~NOTE"), (), ("ADDENDUM",), 0.95),
    Rule(56, "type:late_entry", ("LATE~ENTRY", "DELAYED~ENTRY", "CORRECTION"), (), ("ADDENDUM",), 0.85),
    Rule(57, "type:verbal_order", ("VERBAL~ORDER", "TELEPHONE~ORDER", "T.O.", "V.O.", "READ=BACK"), (), ("ORDER",), 0.92),
    Rule(58, "type:education", ("PATIENT~EDUCATION", "FAMILY~EDUCATION", "TEACHING~NOTE", "DISCHARGE~INSTRUCTION", "HOME~CARE~INSTRUCTION"), (), ("EDUCATION",), 0.88),
    Rule(59, "type:admin_consent", ("CONSENT", "AUTHORIZATION", "RELEASE~OF~INFORMATION", "ROI", "HIPAA"), (), ("ADMINISTRATIVE",), 0.85),
    Rule(60, "type:incident", ("INCIDENT~REPORT", "OCCURRENCE~REPORT", "UNUSUAL~INCIDENT"), (), ("ADMINISTRATIVE",), 0.88),
))

def rule_table(spark: SparkSession, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The pack as a DataFrame, one row per rule."""
    rows = [
        (r.rule_id, r.tag, list(r.phrases), r.veto, list(r.roles), list(r.note_types), r.weight) for r in rules
    ]
    return spark.createDataFrame(
        rows,
        "rule_id int, tag string, phrases array<string>, veto string, "
        "roles array<string>, note_types array<string>, weight double",
    )


def load_rules(table: DataFrame) -> tuple[Rule, ...]:
    """Read a pack back from a table shaped like :func:`rule_table`."""
    return check_rules(
        tuple(
            Rule(
                r.rule_id,
                r.tag,
                tuple(r.phrases),
                tuple(r.roles or ()),
                tuple(r.note_types or ()),
                r.weight,
                r.veto,
            )
            for r in table.collect()
        )
    )


def pack_labels(rules: tuple[Rule, ...], dim: str) -> tuple[str, ...]:
    """Labels of one dimension that the pack can give: taxonomy order, then own additions."""
    used = {label for r in rules for label in r.labels(dim)}
    known = LABELS[dim]
    return tuple(x for x in known if x in used) + tuple(sorted(used - set(known)))


