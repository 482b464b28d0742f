"""Rules, audits, changes and history built from the operators."""
