"""Where rows come from and go to: message streams, calibrations, frame files, archives."""
