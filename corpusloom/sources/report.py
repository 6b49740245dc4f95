"""Small result tables as Markdown."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def to_markdown(df: DataFrame, max_chars: int | None = None) -> str:
    """A result table as a Markdown table, whole; cells are cut only if ``max_chars`` is given."""

    def cell(value: object) -> str:
        if value is None:
            return ""
        text = f"{value:g}" if isinstance(value, float) else str(value)
        text = text.replace("|", "\\|").replace("\n", " ")
        return text[:max_chars] if max_chars else text

    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    lines += ["| " + " | ".join(cell(v) for v in row) + " |" for row in df.toLocalIterator()]
    return "\n".join(lines)


def report(title: str, sections: Mapping[str, DataFrame], max_chars: int | None = None) -> str:
    """A Markdown report with one table per section."""
    parts = [f"# {title}"]
    for heading, table in sections.items():
        parts += [f"## {heading}", to_markdown(table, max_chars)]
    return "\n\n".join(parts) + "\n"
