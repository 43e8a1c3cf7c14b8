"""Jobs, the survey-shaped test view, and the registered queries."""
