"""Frame to frame: type normalisation, catalogs and hierarchies."""
