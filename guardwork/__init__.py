"""Guard audits, run decisions and grant checks for fleets of database servers."""
