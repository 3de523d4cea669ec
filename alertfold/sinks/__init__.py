"""Writers: monthly partitions, audit sets, exactly named files."""
