"""Where the layers of one lake lie."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lake:
    """Folder layout below ``root``, a path every executor can reach."""

    root: str

    @property
    def loans_landing(self) -> str:
        return f"{self.root}/landing/loans"

    @property
    def loans_monthly(self) -> str:
        return f"{self.root}/landing/loans_monthly"

    def macro_landing(self, dataset: str) -> str:
        return f"{self.root}/landing/macro/{dataset}"

    @property
    def loans_bronze(self) -> str:
        return f"{self.root}/bronze/loans"

    def macro_bronze(self, dataset: str) -> str:
        return f"{self.root}/bronze/macro/{dataset}"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/loans"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold/kpi"

    @property
    def fact_state(self) -> str:
        return f"{self.root}/gold/kpi_state"

    @property
    def dashboard(self) -> str:
        return f"{self.root}/gold/dashboard"

    @property
    def alerts(self) -> str:
        return f"{self.root}/gold/alerts"

    @property
    def log(self) -> str:
        return f"{self.root}/gold/process_log"
