"""DataFrame-to-DataFrame operators: profile, drift, checks, baselines, alerts, health."""
