"""Writers: archives, ledger snapshots, audit log."""
