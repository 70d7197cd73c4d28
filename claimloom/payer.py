"""Who the deliveries come from. Every identity constant of the output comes from here."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PayerProfile:
    """Identity constants that replace the payer/market/lob columns of the raw files.

    The raw columns of those names carry wrong metadata, so outputs never trust them.
    """

    payer: str
    market: str
    payer_type: str
    line_of_business: str

    @property
    def data_source(self) -> str:
        return f"{self.payer}|{self.market}|{self.payer_type}"

    @property
    def person_prefix(self) -> str:
        """What precedes the member key in a person id."""
        return f"{self.data_source}."


# The identity the output tables must carry.
DEFAULT_PROFILE = PayerProfile(payer="bcbs", market="MA", payer_type="COMM", line_of_business="COMM")
