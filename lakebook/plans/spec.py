"""What a feature table holds: dimensions x windows x statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Dimension:
    """A text column, the values that get features, and their short names."""

    prefix: str
    column: str
    values: tuple[tuple[str, str], ...]
    statistics: tuple[str, ...]


@dataclass(frozen=True)
class Window:
    """Sales at most ``months`` whole months old; all of them if None."""

    suffix: str
    months: int | None


@dataclass(frozen=True)
class Feature:
    statistic: str
    dimension: Dimension
    label: str
    value: str
    window: Window

    @property
    def name(self) -> str:
        return f"{self.statistic}_{self.dimension.prefix}_{self.label}{self.window.suffix}"


@dataclass(frozen=True)
class FeatureSpec:
    dimensions: tuple[Dimension, ...]
    windows: tuple[Window, ...]

    def features(self) -> Iterator[Feature]:
        """In column order: dimension, statistic, window, value."""
        for dimension in self.dimensions:
            for statistic in dimension.statistics:
                for window in self.windows:
                    for label, value in dimension.values:
                        yield Feature(statistic, dimension, label, value, window)

    def limits(self) -> list[int]:
        """The months of the bounded windows, ascending."""
        return sorted({w.months for w in self.windows if w.months is not None})

    def only(
        self,
        *,
        dimensions: tuple[str, ...] | None = None,
        statistics: tuple[str, ...] | None = None,
    ) -> FeatureSpec:
        """The part of the table with these dimensions and statistics."""
        kept = [d for d in self.dimensions if dimensions is None or d.prefix in dimensions]
        if statistics is not None:
            kept = [
                replace(d, statistics=tuple(s for s in d.statistics if s in statistics))
                for d in kept
            ]
        return replace(self, dimensions=tuple(kept))


# Dimensions, listed values, windows and column order of the book.
BOOK = FeatureSpec(
    dimensions=(
        Dimension(
            prefix="pcat",
            column="product_category",
            values=(
                ("livros", "Livros"),
                ("roupas", "Roupas"),
                ("eletr", "Eletronicos"),
                ("jogos", "Jogos"),
            ),
            statistics=("qtd", "sum", "avg", "min", "max"),
        ),
        Dimension(
            prefix="pm",
            column="payment_method",
            values=(
                ("cd", "Cartao Debito"),
                ("pix", "PIX"),
                ("cc", "Cartao Credito"),
                ("boleto", "Boleto"),
            ),
            statistics=("qtd", "sum", "min", "max", "avg"),
        ),
    ),
    windows=(Window("", None), Window("_u1m", 1), Window("_u3m", 3), Window("_u6m", 6)),
)
