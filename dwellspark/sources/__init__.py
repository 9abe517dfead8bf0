"""Loading of reports, rosters and contacts; writing of results."""
