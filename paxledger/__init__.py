"""paxledger: rule audits, change admission and change history for check-in tables, as Spark plans."""
