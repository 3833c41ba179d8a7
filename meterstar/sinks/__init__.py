"""Writers for the warehouse, the quarantine folder and external stores."""
