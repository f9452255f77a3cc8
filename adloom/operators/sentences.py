"""Sentences of job ads: lines are cleaned, headings and particulars dropped, broken lines joined, the rest split."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Headings, connecting words, particulars and verbs that the rules name.
HEADINGS = {
    "responsibilities", "major responsibilities", "key responsibilities", "job responsibilities", "main responsibilities", "core responsibilities",
    "your responsibilities", "what you will do", "what you'll do", "duties", "key duties", "main duties", "role and responsibilities",
    "qualifications", "requirements", "job requirements", "key requirements", "preferred qualifications", "minimum qualifications",
    "basic qualifications", "required qualifications", "your qualifications", "your profile", "who we are looking for", "what we are looking for",
    "we are looking for", "preferred requirements", "additional requirements", "about us", "about the company", "about the role", "about this role",
    "about the position", "about the job", "about", "company overview", "position overview", "role overview", "job overview", "overview",
    "the opportunity", "the role", "the job", "the position", "what we offer", "we offer", "what we provide", "what you get", "benefits",
    "our benefits", "what's in it for you", "perks", "perks and benefits", "compensation and benefits", "learning and growth", "impactful work",
    "entrepreneurial spirit", "our values", "our culture", "why join us", "why us", "why work with us", "job description", "job details",
    "job information", "job summary", "position details", "job posting", "skills", "required skills", "technical skills", "core skills", "key skills",
    "preferred skills", "tools and technologies", "education", "educational requirements", "academic requirements", "experience", "work experience",
    "relevant experience", "notes", "important", "note", "please note", "how to apply", "application process", "next steps", "application", "contact",
    "inquiries", "for inquiries", "to apply", "open positions", "available positions", "key selling points", "background", "profile",
    "desired candidate profile",
}
CONNECTING = {
    "and", "or", "in", "with", "for", "to", "of", "at", "by", "from", "through", "into", "on", "upon", "between", "within", "about", "that", "which",
    "who", "whose", "whom", "during", "before", "after", "the", "a", "an", "as", "but", "nor", "so", "yet", "both", "either", "neither", "not",
    "only", "just", "also", "including", "such", "per", "via", "than", "when", "where",
}
PARTICULARS = r"job type|pay|salary|work location|location|working hours|work hours|employment type|job id|reference no?\.?|ref\.?|address|phone|tel(?:ephone)?|start date|end date|contract type|duration|work schedule|schedule|shift|deadline|closing date|job category|category|industry|sector|function|department|team|division|reporting to|reports to"
VERBS = r"develop|design|build|implement|manage|support|analy[sz]e|create|maintain|lead|coordinate|collaborat|document|test|use|work|communicat|troubleshoot|debug|improve|deliver|ensure|perform|assist|learn|apply|experience|knowledge|understanding|ability|proficiency|familiarity"
#: What is taken off a line, in this order.
CLEANING = (
    (r"https?://\S+", ""), (r"^(?:>\s*)+", ""), (r"\\([^\s\\])", r"\1"), (r"^[-=_*#]{3,}$", ""), (r"^#{1,4}\s+", ""), (r"^\[.+\]\s*[:\s]\s*", ""),
    (r"^[\s*•·▪▸►→●○◦★☆✓✔⁃‣⦿⦾✅\-–—]+\s*", ""), (r"\*{1,2}([^*]+)\*{1,2}", r"\1"), (r"[\s*]+$", ""), (r"\s+", " "),
)
_CLEANING = [(re.compile(a), b) for a, b in CLEANING]
_DROPPED = re.compile(rf"(?:(?:{PARTICULARS})\s*[:\-])|\S{{40,}}$", re.I)
_VERB = re.compile(rf"\b(?:{VERBS})\b", re.I)
_BREAK = re.compile(r"(?<=[.!?])\s+(?=[A-Z0-9(\"])")
_WORD = re.compile(r"\b\w+\b")


def clean_line(line: str) -> str:
    for pattern, by in _CLEANING:
        line = pattern.sub(by, line)
    return line.strip()


def is_heading(line: str) -> bool:
    key = re.sub(r"[\[\]()*:_]", " ", re.sub(r"^#+\s*", "", line))
    key = " ".join(key.split()).lower()
    if not key:
        return False
    return bool(re.match(r"\[.+\]$", line)) or (len(_WORD.findall(key)) <= 6 and (key in HEADINGS or line.rstrip().endswith(":")))


def _ends(line: str) -> bool:
    """Whether a line may go on: after a comma or a connecting word, or as it is short and names nothing to do; never after a stop."""
    if line[-1] in ".!?:;":
        return False
    words = re.findall(r"\b[\w'-]+\b", line)
    return line[-1] == "," or bool(words) and (words[-1].lower() in CONNECTING or (len(words) <= 3 and not _VERB.search(line)))


def _continues(line: str) -> bool:
    first = line.split(None, 1)[0].lower().strip(".,;:()[]\"'")
    return line[0].islower() or line[0] in ",;)]" or first in CONNECTING


def sentences(text: str | None, least_chars: int = 10, least_words: int = 2) -> list[str]:
    """The sentences of an ad. NULL and blank texts have none."""
    units: list[str] = []
    open_ = False  # whether the last unit may still grow
    for line in filter(None, map(clean_line, (text or "").split("\n"))):
        if _DROPPED.match(line) or is_heading(line):
            open_ = False
        elif open_ and _ends(units[-1]) and _continues(line):
            units[-1] += " " + line
        elif len(line) >= 3:
            units.append(line)
            open_ = True
        # a shorter line begins nothing and, as no unit goes on in it, ends the one before
        else:
            open_ = False
    parts = (" ".join(p.split()) for u in units for p in _BREAK.split(u))
    return [p for p in parts if len(p) >= least_chars and len(_WORD.findall(p)) >= least_words]


def split_ads(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, sentence), in Arrow batches and without a shuffle."""

    def read(batches):
        for b in batches:
            rows = [(i, k, s) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for k, s in enumerate(sentences(t))]
            ids, pos, text = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(pos, pa.int64()), pa.array(text, pa.string())], ["id", "pos", "sentence"])

    return df.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(read, "id long, pos long, sentence string")
