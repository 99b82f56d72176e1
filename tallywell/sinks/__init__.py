"""Writers of results, quarantine, reports and warehouse tables."""
