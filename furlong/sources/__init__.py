"""Table readers/writers, fixture derivation and the SQL oracle texts."""
