"""Table builds, jobs and analytic marts."""
