"""Market reports whose every figure names its source."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass
class Report:
    """Paragraphs in order, each with the sources it rests on; numbers come from small aggregates alone."""

    title: str
    week: str
    most_rows: int = 50
    sources: list[tuple[str, str, str]] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)

    def source(self, table: str, site: str) -> str:
        """The mark of a source, numbered by its first use."""
        known = (table, site, self.week)
        if known not in self.sources:
            self.sources.append(known)
        return f"[source: S{self.sources.index(known) + 1}, {self.week}]"

    def paragraph(self, text: str, table: str, site: str = "all") -> None:
        self.parts.append(f"{text} {self.source(table, site)}")

    def table(self, heading: str, df: DataFrame, order: list, table: str, site: str = "all") -> None:
        """The first rows of an aggregate by ``order``: Spark keeps only those of each task."""
        rows = df.orderBy(*order).limit(self.most_rows).collect()
        lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        lines += ["| " + " | ".join("" if v is None else str(v) for v in row) + " |" for row in rows]
        self.parts.append(f"## {heading}\n\n" + "\n".join(lines) + f"\n\n{self.source(table, site)}")

    def audit(self) -> list[str]:
        """Problems: parts without a source."""
        return [f"part {i + 1} names no source" for i, part in enumerate(self.parts) if "[source: S" not in part]

    def markdown(self) -> str:
        listed = [f"- S{i + 1}: {table}, {site}, {week}" for i, (table, site, week) in enumerate(self.sources)]
        return "\n\n".join([f"# {self.title}", *self.parts, "## Sources", "\n".join(listed)]) + "\n"
