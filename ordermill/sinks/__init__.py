"""Writers: raw and quarantine layers, keyed tables, split files, lookup layouts."""
