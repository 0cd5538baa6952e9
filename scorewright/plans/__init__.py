"""Plans: the registered queries, publishing, retention, ledger, freshness and the weekly job."""
