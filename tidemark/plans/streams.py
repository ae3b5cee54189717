"""The stock streams: how each is read and how often, as data."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Stream:
    """Read mode, change field (source spelling), key for comparisons, schedule."""

    table: str
    endpoint: str
    request_type: str
    cdc_field: str = ""
    key: str = ""
    schedule: str = "every 30 minutes"

    def event(self, **extra) -> dict:
        """The ingest event of a scheduled run."""
        base = {"table_name": self.table, "endpoint": self.endpoint, "request_type": self.request_type}
        return {**base, "cdc_field": self.cdc_field, **extra}


# The streams in use.
STREAMS = {
    stream.table: stream
    for stream in (
        Stream("users", "users", "get", key="id", schedule="daily"),
        Stream("gl_accounts", "glaccounts", "get", key="gl_code", schedule="daily"),
        Stream("loan_accounts_installments", "installments", "get", key="encoded_key", schedule="daily"),
        Stream("loan_products", "loanproducts", "get", schedule="daily"),
        Stream("gl_journal_entries", "gljournalentries:search", "post", "creationDate", "entry_id"),
        Stream("loan_accounts", "loans:search", "post", "lastModifiedDate", "id"),
        Stream("loan_transactions", "loans/transactions:search", "post", "creationDate", "id"),
        Stream("deposit_accounts", "deposits:search", "post", "lastModifiedDate", "id"),
        Stream("deposit_transactions", "deposits/transactions:search", "post", "creationDate", "encoded_key"),
        Stream("clients", "clients:search", "post", "lastModifiedDate", "id"),
        Stream("accounting_interestaccrual", "accounting/interestaccrual:search", "post", "creationDate"),
        Stream("groups", "groups:search", "post", "lastModifiedDate", schedule="daily"),
        # Known but not scheduled.
        Stream("communications_messages", "communications/messages:searchSorted", "post", "creationDate", schedule=""),
        Stream("credit_arrangements", "creditarrangements:search", "post", "approvedDate", schedule=""),
    )
}
