"""DataFrame-to-DataFrame operators over keyed time-series tables."""
